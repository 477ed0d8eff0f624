"""Hard negatives by inner product, with score bounds along a spanning tree of the anchors.

Anchors are taken in blocks of at most ``ANCHORS`` (sorted by label, so that a block's anchors are alike);
a block with its tree is broadcast and every other row is scored where it is read. The tree
is a minimum spanning tree of the block. At the root all scores are exact. At a child, the score of a candidate
x lies within edge length * |x| of its score at the parent, and within |anchor| * |x| of zero. Only
candidates whose bounds overlap the child's window are scored again; the others pass on their
bounds. The window of the first pass (positives) begins at the fifth best score found so far in the task,
those of the second (negatives) are the bands below the positives' scores, cut in the same way.
A task returns the best few rows of each anchor, or of each anchor and positive; a window merges them.
What the driver holds is one block of anchors and their positives.

Scores are whole numbers. They are computed in double precision where the norms prove that to be
exact, else in whole numbers of any length; a score that does not fit a long is an error.

Defined results: a row with a null vec_id or label, a null vector, or a null or non-finite component
takes no part; of rows that share a vec_id one takes part, the smallest by label and vector; a
shorter vector is filled up with zeros; ties go to the smaller vec_id; an anchor without positives, or a
positive without rows in its band, gives no rows; an empty table gives none; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.llm.common import on_cluster_disk, read_table
from docflow.llm.flatwords import spread
from docflow.session import scratch_path

ANCHORS = 2048
CHUNK = 4096
#: Whole numbers up to here are exact in double precision.
EXACT = float(1 << 53)
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_numbers(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of list rows, one row each, short rows filled up with zeros."""
    edges = vectors.offsets.to_numpy().astype(np.int64)
    flat = np.floor(scale * np.asarray(vectors.flatten(), dtype=np.float64))
    if not np.isfinite(flat).all():
        raise OverflowError("a component is too large to scale")
    size = np.diff(edges)
    width = int(size.max()) if len(size) else 0
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), spread(np.zeros(len(size), dtype=np.int64), size)] = flat
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, initial=0.0)
    safe = np.where(top > 0, top, 1.0)
    return top * np.sqrt(np.square(x / safe[:, None]).sum(axis=1)) * (1 + 1e-12)


def exact_scores(x: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any length."""
    return np.array([sum(map(lambda p, q: int(p) * int(q), row, anchor)) for row in x.tolist()], dtype=object)


@dataclass
class Tree:
    """Anchors of a block, and for each the children and its distance from its parent."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    norm: np.ndarray = field(init=False)
    children: list[list[int]] = field(init=False)
    edge: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        """Minimum spanning tree around anchor 0 (Prim); of children the one with most descendants comes last."""
        n = len(self.ids)
        self.norm = norms(self.q)
        unit = float(np.abs(self.q).max(initial=0.0)) or 1.0
        x = self.q / unit
        square = np.square(x).sum(axis=1)
        near, parent = np.full(n, np.inf), np.full(n, -1)
        waiting = np.ones(n, dtype=bool)
        order, at = [0], 0
        waiting[:1] = False
        for _ in range(n - 1):
            apart = square + square[at] - 2.0 * (x @ x[at])
            closer = waiting & (apart < near)
            near[closer], parent[closer] = apart[closer], at
            at = int(np.where(waiting, near, np.inf).argmin())
            if not waiting[at]:
                at = int(waiting.argmax())
            parent[at] = max(parent[at], 0)
            waiting[at] = False
            order.append(at)
        below = np.ones(n, dtype=np.int64)
        for k in reversed(order[1:]):
            below[parent[k]] += below[k]
        self.children = [[] for _ in range(n)]
        for k in order[1:]:
            self.children[parent[k]].append(k)
        for own in self.children:
            own.sort(key=lambda k: -below[k])
        self.edge = np.zeros(n)
        if n > 1:
            self.edge[order[1:]] = norms(self.q[order[1:]] - self.q[parent[order[1:]]])

    def walk(self, x: np.ndarray, norm: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, exact scores) for each anchor; ``wanted(anchor, low, high)`` names the candidates to score."""
        if not len(self.ids) or not len(x):
            return
        width = max(x.shape[1], self.q.shape[1])
        x, q = widened(x, width), widened(self.q, width)
        exact = float(norm.max()) * float(self.norm.max()) < EXACT
        everywhere = np.full(len(x), np.inf)
        slack = 1e-9 * norm * max(float(self.norm.max()), 1.0) + 1e-6
        stack = [(0, -everywhere, everywhere)]
        while stack:
            k, low, high = stack.pop()
            if not exact:
                pick = wanted(k, -everywhere, everywhere)
                yield k, pick, exact_scores(x[pick], q[k])
                stack += [(c, low, high) for c in self.children[k]]
                continue
            reach = self.edge[k] * norm + slack
            cap = self.norm[k] * norm + slack
            low, high = np.maximum(low - reach, -cap), np.minimum(high + reach, cap)
            if k == 0:
                low = high = x @ q[0]
            pick = wanted(k, low, high)
            score = x[pick] @ q[k]
            if len(pick) and k:
                low[pick] = high[pick] = score
            yield k, pick, score.astype(np.int64)
            # the child with most descendants lies lowest, so few parents' bounds are alive at a time
            stack += [(c, low, high) for c in self.children[k]]


class Best:
    """The first few (score, id) of many, higher scores first, ties by smaller id."""

    def __init__(self, size: int):
        self.size, self.scores, self.ids = size, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.size else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(ids):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = sorted(range(len(ids)), key=lambda k: (-scores[k], ids[k])) if scores.dtype == object else np.lexsort((ids, -scores))
        self.scores, self.ids = scores[order[: self.size]], ids[order[: self.size]]


def _chunks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            part = batch.slice(lo, CHUNK)
            x = whole_numbers(part.column(2), scale)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), x, norms(x)


def positives(rows: DataFrame, tree: Tree, scale: float, size: int) -> DataFrame:
    """(anchor, positive_id, positive_score, place) of the first ``size`` rows of each anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)  # ANCHORS rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Tree = shared.value
        best = [Best(size) for _ in block.ids]
        for ids, labels, x, norm in _chunks(batches, scale):
            def wanted(k: int, low: np.ndarray, high: np.ndarray, ids=ids, labels=labels) -> np.ndarray:
                return np.flatnonzero((high >= best[k].floor()) & (labels == block.labels[k]) & (ids != block.ids[k]))

            for k, pick, score in block.walk(x, norm, wanted):
                best[k].add(score, ids[pick])
        held = [k for k, b in enumerate(best) for _ in b.ids]
        score = [int(s) for b in best for s in b.scores]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([int(i) for b in best for i in b.ids], pa.int64()), pa.array(score, pa.int64())], names=["anchor", "positive_id", "positive_score"])

    found = rows.mapInArrow(run, "anchor int, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("place", place).filter(F.col("place") <= size)


def negatives(rows: DataFrame, tree: Tree, held: list[tuple[int, int, int]], scale: float, size: int, low_percent: int) -> DataFrame:
    """``RESULT`` rows of a block; held: (anchor, positive_id, positive_score) of its anchors."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pairs = shared.value
        own: list[list[tuple[int, int, int, Best]]] = [[] for _ in block.ids]
        for k, positive, score in pairs:
            lowest = -((-low_percent * score) // 100)
            if lowest <= score:
                own[k].append((positive, score, lowest, Best(size)))
        for ids, labels, x, norm in _chunks(batches, scale):
            def wanted(k: int, low: np.ndarray, high: np.ndarray, labels=labels) -> np.ndarray:
                if not own[k]:
                    return np.empty(0, dtype=np.int64)
                floors = [max(float(lowest), b.floor()) for _, _, lowest, b in own[k]]
                pick = np.flatnonzero((high >= min(floors)) & (low <= max(s for _, s, _, _ in own[k])) & (labels != block.labels[k]))
                in_one = np.zeros(len(pick), dtype=bool)
                for f, (_, s, _, _) in zip(floors, own[k]):
                    in_one |= (high[pick] >= f) & (low[pick] <= s)
                return pick[in_one]

            for k, pick, score in block.walk(x, norm, wanted):
                for _, s, lowest, best in own[k]:
                    inside = (score <= s) & (score >= lowest)
                    best.add(score[inside], ids[pick[inside]])
        out = [(int(block.ids[k]), p, int(i), s, int(v)) for k, each in enumerate(own) for p, s, _, best in each for v, i in zip(best.scores, best.ids)]
        columns = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    found = rows.mapInArrow(run, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= size).select(*(c.split()[0] for c in RESULT.split(", ")))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding: one row for each vec_id, without rows that take no part."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    return one.select("vec_id", "row.label", "row.embedding")


def hard_negatives(vectors: DataFrame, is_anchor, scale: float = 256.0, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, block: int = ANCHORS) -> DataFrame:
    """``RESULT`` rows: for each anchor and positive, the first rows of other labels in the band below the positive's score.

    ``vectors(vec_id, label, embedding)``; ``is_anchor``: condition on vec_id that picks the anchors.
    """
    spark = vectors.sparkSession
    rows = on_cluster_disk(usable(vectors))
    anchors = on_cluster_disk(rows.filter(is_anchor).orderBy("label", "vec_id"))
    path = scratch_path(spark, "hard_negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    held: list = []

    def mine() -> None:
        q = whole_numbers(pa.array([r.embedding for r in held], pa.list_(pa.float64())), scale)
        tree = Tree(np.array([r.vec_id for r in held]), np.array([r.label for r in held]), q)
        pairs = [(r.anchor, r.positive_id, r.positive_score) for r in positives(rows, tree, scale, n_positives).collect()]  # n_positives for each anchor of the block
        negatives(rows, tree, sorted(pairs), scale, n_negatives, low_percent).write.mode("append").parquet(path)
        held.clear()

    for row in anchors.toLocalIterator():
        held.append(row)
        if len(held) == block:
            mine()
    if held:
        mine()
    return spark.read.schema(RESULT).parquet(path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: vec_id divisible by 100, against all embeddings; labels of every seventh vec_id are moved by one first."""
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
