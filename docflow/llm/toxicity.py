"""Toxicity by non-negative positive-unlabelled learning.

Features are hashed words and 5-byte windows of words (with the blanks around them), present or
absent, so spellings that share a stem share features. The confirmed toxic rows of the training
folds are the positives; a sample of all labelled training rows, with their labels unread, is the
unlabelled text. The class prior is the share of toxic rows among all labelled training rows. A
linear numpy classifier minimises

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the sigmoid loss: when the bracket turns negative, its gradient is turned round, so the
classifier cannot learn to call unlabelled positives clean.

Bounds: at most ``MAX_POSITIVES`` positive and ``MAX_UNLABELLED`` unlabelled training rows, those
with the lowest hash of their id. Rows that share an id train as one, the text with the lowest hash
(a null text only if there is no other). Features are counted over these rows by Spark; only features
that occur clearly more often in positives than in unlabelled text keep a weight. Scoring reads
every whole text.

Defined results: a null or empty text has no features and gets the score of the bias; without
positives the score is the prior; repeated ids are scored each; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docflow.llm.common import label_fold, read_documents, read_table
from docflow.llm.textwords import _LOWER, ALNUM, mix, text_blocks, words_of

BITS = 20
MAX_POSITIVES = 6000
MAX_UNLABELLED = 12000
MIN_POSITIVES = 3  # documents a feature must occur in
MIN_LIFT = 2.5  # lower bound of how much more often in positives than in unlabelled text


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of each word and window, and its byte place, unsorted."""
    w = words_of(data, offsets, ALNUM)
    n = len(data)
    low = _LOWER[data]
    blank = ~ALNUM[low]
    wide = np.where(blank, np.uint8(32), low).astype(np.uint64)
    shift = np.uint64(64 - BITS)
    word_feature = mix(w.hashes ^ np.uint64(0x5851F42D4C957F2D)) >> shift
    if n < 5:
        return word_feature.astype(np.int64), w.begin
    packed = np.zeros(n - 4, dtype=np.uint64)
    for j in range(5):
        packed = (packed << np.uint64(8)) | wide[j : n - 4 + j]
    use = ~(blank[1 : n - 3] | blank[2 : n - 2] | blank[3 : n - 1])
    cut = offsets[1:-1]
    for j in range(1, 5):  # no window across two documents
        at = cut - j
        use[at[(at >= 0) & (at < len(use))]] = False
    place = np.flatnonzero(use)
    feature = mix(packed[place] ^ np.uint64(0x14057B7EF767814F)) >> shift
    return np.concatenate([word_feature, feature]).astype(np.int64), np.concatenate([w.begin, place])


def present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document of the block, feature) pairs; only features that ``wanted`` marks, if given."""
    feature, place = _windows(data, offsets)
    if wanted is not None:
        on = wanted[feature]
        feature, place = feature[on], place[on]
    doc = np.searchsorted(offsets, place, side="right") - 1
    pairs = np.unique((doc.astype(np.int64) << BITS) | feature)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Linear:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        full = np.zeros(1 << BITS)
        full[self.features] = self.weights
        return full


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def train(
    rows: list[tuple[bool, np.ndarray]], features: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-5
) -> Linear:
    """Non-negative risk over (is positive, positions in ``features``) rows, by full-batch Adam from zero weights."""
    n = len(features)
    side = np.array([p for p, _ in rows], dtype=bool)
    if not side.any() or side.all():
        return Linear(features[:0], np.zeros(0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    sizes = np.array([len(x) for _, x in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    column = np.concatenate([x for _, x in rows]).astype(np.int64)
    theta = np.zeros(n + 1)
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    n_pos, n_unl = side.sum(), (~side).sum()
    for step in range(1, steps + 1):
        z = np.bincount(owner, weights=theta[column], minlength=len(rows)) + theta[n]
        s = _sigmoid(z)  # loss as clean: s; loss as toxic: 1 - s
        slope = s * (1 - s)
        rest = s[~side].mean() - prior * s[side].mean()
        if rest >= 0:
            g = np.where(side, -2 * prior * slope / n_pos, slope / n_unl)
        else:  # turn the overfitted part round
            g = np.where(side, prior * slope / n_pos, -slope / n_unl)
        grad = np.r_[np.bincount(column, weights=g[owner], minlength=n), g.sum()]
        grad[:n] += decay * theta[:n]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta[:n] = np.maximum(theta[:n], 0.0)  # every feature was chosen as evidence for toxicity
    return Linear(features, theta[:n], float(theta[n]))


def select_features(counts: DataFrame, positives: int, unlabelled: int) -> np.ndarray:
    """Features whose share in positives, less one standard error, is MIN_LIFT times that in unlabelled text (at most 2**BITS numbers)."""
    p = F.col("positives") / F.lit(float(max(positives, 1)))
    u = (F.col("unlabelled") + F.lit(1.0)) / F.lit(float(unlabelled + 1))
    low = p - F.sqrt(p / F.lit(float(max(positives, 1))))
    chosen = counts.filter((F.col("positives") >= MIN_POSITIVES) & (low >= F.lit(MIN_LIFT) * u)).select("feature")
    return np.sort(np.array([r[0] for r in chosen.collect()], dtype=np.int64))


def sample_rows(labels: DataFrame, modulus: int, held_out: int, max_pos: int, max_unl: int) -> tuple[DataFrame, float, int, int]:
    """Training ids (doc_id, positive), class prior and sizes. Labels of one id that disagree count as toxic."""
    own = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(label_fold(F.col("doc_id"), modulus) != held_out)
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = own.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    pos = own.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_pos).select("doc_id", F.lit(True).alias("positive"))
    unl = own.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_unl).select("doc_id", F.lit(False).alias("positive"))
    return pos.unionByName(unl), (toxic + 0.5) / (n + 1.0), min(toxic, max_pos), min(n, max_unl)


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, max_pos: int = MAX_POSITIVES, max_unl: int = MAX_UNLABELLED) -> Linear:
    from docflow.llm.common import on_cluster_disk

    ids, prior, _, _ = sample_rows(labels, modulus, held_out, max_pos, max_unl)
    ids = on_cluster_disk(ids)  # at most max_pos + max_unl rows
    sampled = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi")
    # one text for each id, combined before the shuffle: a repeated id adds no row
    one = sampled.groupBy("doc_id").agg(F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"), "text")).alias("text"))
    rows = on_cluster_disk(one.join(F.broadcast(ids), "doc_id").select("positive", "text"))
    sizes = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            side = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, _, data, offsets in text_blocks(batch.column(1)):
                doc, feature = present(data, offsets)
                for c in (0, 1):
                    sums[c] += np.bincount(feature[side[lo + doc] == c], minlength=1 << BITS)
        own = np.flatnonzero(sums[1])
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[1, own]), pa.array(sums[0, own])], names=["feature", "positives", "unlabelled"])

    def count_unlabelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                sums += np.bincount(present(data, offsets)[1], minlength=1 << BITS)
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.zeros(len(own), dtype=np.int64)), pa.array(sums[own])], names=["feature", "positives", "unlabelled"])

    kind = "feature long, positives long, unlabelled long"
    parts = rows.filter("positive").mapInArrow(count, kind).unionByName(rows.filter("not positive").select("text").mapInArrow(count_unlabelled, kind))
    totals = parts.groupBy("feature").agg(F.sum("positives").alias("positives"), F.sum("unlabelled").alias("unlabelled"))
    features = select_features(totals, n_pos, n_unl)
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[features] = True
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                doc, feature = present(data, offsets, shared.value)
                edges = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(edges), pa.array(feature))], names=["positive", "found"])

    encoded = rows.mapInArrow(encode, "positive boolean, found array<long>").collect()  # bounded sample
    encoded.sort(key=lambda r: (r["positive"], r["found"]))
    return train([(r["positive"], np.searchsorted(features, r["found"])) for r in encoded], features, prior)


def score(docs: DataFrame, model: Linear) -> DataFrame:
    """The input with ``toxicity``, 0 to 1 (its columns stay; one of that name is replaced)."""
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField("toxicity", DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = model.table()
        wanted = table != 0
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(at)):
                doc, feature = present(data, offsets, wanted)
                z = np.bincount(doc, weights=table[feature], minlength=hi - lo) + model.bias
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(_sigmoid(z))], names=schema.names)

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; fold 1 of 3 is never trained on."""
    docs = read_documents(spark, sf_dir)
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", (label_fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted")
    )
