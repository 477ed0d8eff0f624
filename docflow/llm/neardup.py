"""MinHash near duplicates by an LSH forest of 16 sorted orders, confirmed on full shingle sets.

A text's set holds its distinct word shingles. Texts with equal sets are one class, and the work
below is on one member of each. ``SLOTS`` minhashes make ``TREES`` trees of 16. Every tree is an order: its
members are sorted by their minhashes, over all tasks by ranges, and in this order each member gets the length of
the longest common prefix with its neighbours. A region is a run of neighbours with a common prefix of at least
``SHALLOW`` minhashes, and its members are candidates; who has no such neighbour is alone in the tree. Depth adapts
to the region: a run of more than ``CROWD`` members is cut where the common prefix is shorter than one more minhash,
down to ``DEEP``. A run that crosses a border between two tasks is one region, as its prefix names it. Deeper levels
would cost recall: a pair at similarity 0.8 shares d minhashes of one tree with probability 0.8**d and
is missed by all 16 with (1 - 0.8**d)**16, which is about 1 in 100,000 at d = 3, 1 in 5,000 at d = 4 and
1 in 600 at d = 5. So only pairs in crowded regions that share two minhashes in every one of their trees' common
runs, and three in none, are lost: 1 in 100,000 at the threshold, and fewer above it.

Crowded regions are not compared pair by pair. A region elects its most typical member, the one
whose sketch agrees most with the region's majority, through blocks of bounded size; a member's
best elected neighbour over all trees names its family. Texts are then compared within families,
in pairs of blocks, on full sets. Of two members of a region that are in different families and
whose sketches may reach the threshold, the one of the smaller family becomes a guest of the
other's, and guests are compared with the whole family in blocks too. So every candidate is
settled, and only links that join the parts of a block leave it.

Defined results: a null text, and one without words, has an empty set, links with nothing and is
kept; a text with fewer words than a shingle is one shingle; rows that repeat are copies; rows
that share a doc_id count as linked; a null doc_id has no component and is not kept; an empty
table gives no rows; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from docflow.llm.common import mark_members, on_cluster_disk, read_documents, whole_groups
from docflow.llm.components import components
from docflow.llm.embeddings import roots
from docflow.llm.textwords import NON_SPACE, grams, mix, text_blocks, words_of

TREES = 16
SLOTS = 256
SHALLOW, DEEP = 2, 3  # least common prefix of a region, and the least in a crowded one
CROWD = 64  # a region with more members goes one minhash deeper
BLOCK = 512  # members compared by sketch at once
SET_BLOCK = 256  # members compared by full set at once
SLACK = 0.12  # sketches this far below the threshold still go to the full sets (5 standard errors)

_RNG = np.random.Generator(np.random.PCG64(77))
_XOR = _RNG.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, SLOTS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    for lo, hi, data, offsets in text_blocks(column):
        words = words_of(data, offsets, NON_SPACE)
        for i in range(hi - lo):
            own = words.hashes[words.first[i] : words.first[i + 1]]
            yield np.unique(grams(own, min(width, len(own)))) if len(own) else own


def minhashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SLOTS, (1 << 32) - 1, dtype=np.uint32)
    for at in range(0, len(shingles), 1024):
        h = ((shingles[at : at + 1024, None] ^ _XOR) * _MUL) >> np.uint64(32)
        least = np.minimum(least, h.min(axis=0).astype(np.uint32))
    return least


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, two keys of the set, its place in every order (the first minhashes of a tree, as sortable bytes), and the sketch (a byte for each minhash)."""
    schema = StructType(
        [
            StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("key", LongType()), StructField("key2", LongType()),
            StructField("orders", ArrayType(BinaryType(), False)), StructField("sketch", BinaryType()),
        ]
    )
    kind = pa.list_(pa.field("element", pa.binary(), False))
    step = SLOTS // TREES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, key, key2, least = [], [], [], []
                for s in shingle_sets(part.column(1), width):
                    n.append(len(s))
                    key.append(mix(s).sum(dtype=np.uint64))
                    key2.append(mix(s ^ np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
                    least.append(minhashes(s))
                least = np.array(least, dtype=np.uint32).reshape(-1, SLOTS)
                places = np.ascontiguousarray(least.reshape(len(n), TREES, step)[:, :, :DEEP].astype(">u4")).tobytes()
                edges = np.arange(len(n) * TREES + 1, dtype=np.int32) * (4 * DEEP)
                flat = pa.Array.from_buffers(pa.binary(), len(n) * TREES, [None, pa.py_buffer(edges), pa.py_buffer(places)])
                orders = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * TREES), flat, type=kind)
                sketch = np.ascontiguousarray((least & 0xFF).astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n, pa.int64()), pa.array(np.array(key, dtype=np.uint64).view(np.int64)), pa.array(np.array(key2, dtype=np.uint64).view(np.int64)),
                        orders, pa.array([r.tobytes() for r in sketch], pa.binary()),
                    ],
                    names=schema.names,
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def common_prefix(tree: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Minhashes that each row of an order shares from the start with the row before (the first row: none)."""
    same = (place[1:] == place[:-1]) & (tree[1:] == tree[:-1])[:, None]
    return np.r_[0, np.minimum.accumulate(same, axis=1).sum(axis=1)]


def forest(reps: DataFrame) -> DataFrame:
    """(tree, place, node): the members of every order that share ``SHALLOW`` minhashes with a neighbour.

    Sorted by ranges of (tree, place, node), so even a run of equal places is spread over tasks. The first and
    the last row of a task have neighbours elsewhere and stay; their region decides.
    """
    rows = reps.select("node", F.posexplode("orders").alias("tree", "place")).select("tree", "place", "node")
    ordered = rows.repartitionByRange("tree", "place", "node").sortWithinPartitions("tree", "place", "node")

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch waits for the next one, whose first row its last row is compared with."""
        held, before = None, DEEP
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                held = batch
                continue
            keep, before = linked(held, before, batch.slice(0, 1))
            yield keep
            held = batch
        if held is not None:
            yield linked(held, before, None)[0]

    def linked(batch: pa.RecordBatch, before: int, after: pa.RecordBatch | None) -> tuple[pa.RecordBatch, int]:
        """Rows with a near neighbour, and the prefix that the last row shares with the row behind it."""
        seen = pa.Table.from_batches([batch] if after is None else [batch, after]).combine_chunks()
        place = np.frombuffer(b"".join(seen.column("place").to_pylist()), dtype=">u4").reshape(-1, DEEP)
        prefix = np.r_[common_prefix(seen.column("tree").to_numpy(), place), DEEP]
        prefix[0] = before
        near = np.maximum(prefix[:-1], prefix[1:]) >= SHALLOW
        return batch.filter(pa.array(near[: batch.num_rows])), int(prefix[batch.num_rows])

    return ordered.mapInArrow(neighbours, rows.schema)


def regions(reps: DataFrame) -> DataFrame:
    """(tree, region, node, size): members of every region with two or more, at the depth that its crowd asks for."""
    left = on_cluster_disk(forest(reps))
    out = None
    for depth in range(SHALLOW, DEEP + 1):
        # a task of the sorted order sends one count for each run that it holds
        rows = left.withColumn("region", F.xxhash64(F.substring("place", 1, 4 * depth)))
        sizes = rows.groupBy("tree", "region").agg(F.count("*").alias("size")).filter("size > 1")
        sized = rows.join(sizes, ["tree", "region"])
        done = (sized if depth == DEEP else sized.filter(F.col("size") <= CROWD)).select("tree", "region", "node", "size")
        out = done if out is None else out.unionByName(done)
        left = sized.filter(F.col("size") > CROWD).select("tree", "place", "node")
    return out


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SLOTS)


def _typical(sketch: np.ndarray) -> int:
    """Index of the row that agrees most with all rows, summed over the slots; the first of equal ones."""
    if len(sketch) <= 2:
        return 0
    if len(sketch) <= 32:  # all pairs of few rows; else a count of the values of each slot, with the same sums
        return int((sketch[:, None, :] == sketch[None, :, :]).sum(axis=(1, 2)).argmax())
    agree = np.zeros(len(sketch))
    for s in range(SLOTS):
        counts = np.bincount(sketch[:, s], minlength=256)
        agree += counts[sketch[:, s]]
    return int(agree.argmax())


def busy_tasks(df: DataFrame) -> int:
    """Tasks for work whose cost is computing, not bytes: a number that adaptive execution leaves as it is."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def elect(members: DataFrame) -> DataFrame:
    """The most typical member of every region (tree, region, pivot, pivot_sketch).

    Blocks elect first; the elected of a region meet in blocks again until one is left.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in whole_groups(batches, 3):
            sketch = _sketches(rows.column("sketch"))
            pick = [int(a) + _typical(sketch[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield rows.take(pa.array(pick, pa.int64())).select(["tree", "region", "node", "sketch"])

    left = members.select("tree", "region", "node", "sketch", "size")
    while True:
        blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
        dealt = left.withColumn("block", F.pmod(F.xxhash64("node", "tree"), blocks).cast("int")).select("tree", "region", "block", "node", "sketch")
        schema = StructType([dealt.schema[n] for n in ("tree", "region", "node", "sketch")])
        ordered = dealt.repartition(busy_tasks(dealt), "tree", "region", "block").sortWithinPartitions("tree", "region", "block", "node")
        elected = on_cluster_disk(ordered.mapInArrow(vote, schema))
        sizes = elected.groupBy("tree", "region").agg(F.count("*").alias("size"))
        if not sizes.filter("size > 1").take(1):
            return elected.select("tree", "region", F.col("node").alias("pivot"), F.col("sketch").alias("pivot_sketch"))
        left = elected.join(sizes, ["tree", "region"])


def families(members: DataFrame, pivots: DataFrame, least: float) -> DataFrame:
    """(node, family): the family is named by the elected member that a node agrees with most, over all trees."""
    schema = "node long, pivot long, agree double"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (_sketches(batch.column(2)) == _sketches(batch.column(3))).mean(axis=1)
            on = pa.array(agree >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(on), batch.column(1).filter(on), pa.array(agree).filter(on)], names=["node", "pivot", "agree"])

    # a crowded region is dealt to several tasks, each with its elected member
    parts = F.ceil(F.col("size") / F.lit(8 * BLOCK)).cast("int")
    sizes = members.groupBy("tree", "region").agg(F.max("size").alias("size"))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    heads = pivots.join(sizes, ["tree", "region"]).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("size")
    by = ["tree", "region", "part"]
    tasks = busy_tasks(members)
    near = dealt.repartition(tasks, *by).join(heads.repartition(tasks, *by), by).filter("node <> pivot").select("node", "pivot", "sketch", "pivot_sketch").mapInArrow(compare, schema)
    best = on_cluster_disk(near.groupBy("node").agg(F.max_by("pivot", F.struct("agree", -F.col("pivot"))).alias("family")))
    for _ in range(2):  # an elected member may belong to a family itself
        up = best.select(F.col("node").alias("family"), F.col("family").alias("upper"))
        best = best.join(up, "family", "left").select("node", F.coalesce("upper", "family").alias("family"))
    named = best.select(F.col("family").alias("node"), "family").distinct()
    return named.unionByName(best.join(named.select("node"), "node", "left_anti"))


def across_families(members: DataFrame, family: DataFrame, least: float) -> DataFrame:
    """(home, node): nodes of a region whose sketches may reach the threshold with a member of another family.

    Of two families the larger is the home and the other's node its guest, so a crowd of copies
    gives a row for each guest and none for each pair. In a region of several blocks the rows
    outside its largest family meet all rows, block by block.
    """
    sized = family.join(family.groupBy("family").agg(F.count("*").alias("weight")), "family")
    rows = members.join(sized, "node", "left").withColumn("family", F.coalesce("family", "node")).withColumn("weight", F.coalesce("weight", F.lit(1)))
    per = rows.groupBy("tree", "region", "family").agg(F.count("*").alias("n"))
    top = per.groupBy("tree", "region").agg(F.max_by("family", F.struct("n", "family")).alias("largest"), F.sum("n").alias("total"), F.max("n").alias("most"))
    top = top.filter("most < total").select("tree", "region", "largest", "total", (F.col("total") - F.col("most")).alias("others"))
    rows = rows.select("tree", "region", "node", "family", "weight", "sketch").join(top, ["tree", "region"])
    blocks, minor = (F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("total", "others"))
    rows = rows.withColumn("blocks", blocks).withColumn("minor", minor).withColumn("small", F.col("family") != F.col("largest"))
    every = rows.withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("minor") - 1)))
    own = rows.filter("small").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("j", F.pmod(F.xxhash64("node"), F.col("minor")).cast("int"))
    pick = lambda df, side: df.select("tree", "region", "i", "j", F.lit(side).alias("side"), "node", "family", "weight", "small", "sketch")
    dealt = pick(every, 0).unionByName(pick(own, 1))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in whole_groups(batches, 4):
            side = rows.column("side").to_numpy()
            node = rows.column("node").to_numpy()
            fam = rows.column("family").to_numpy()
            weight = rows.column("weight").to_numpy()
            small = rows.column("small").to_numpy(zero_copy_only=False)
            sketch = _sketches(rows.column("sketch"))
            found = [np.empty((0, 2), dtype=np.int64)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                minors = lo + np.flatnonzero(side[lo:hi] == 1)
                alls = lo + np.flatnonzero(side[lo:hi] == 0)
                block = []
                for m in minors:
                    other = alls[(fam[alls] != fam[m]) & (~small[alls] | (node[alls] > node[m]))]
                    near = other[(sketch[other] == sketch[m]).mean(axis=1) >= least]
                    host = (weight[near] < weight[m]) | ((weight[near] == weight[m]) & (fam[near] > fam[m]))
                    guests, homes = node[near[host]], np.unique(fam[near[~host]])
                    block.append(np.column_stack([np.full(len(guests), fam[m]), guests]))
                    block.append(np.column_stack([homes, np.full(len(homes), node[m])]))
                if block:
                    found.append(np.unique(np.concatenate(block), axis=0))
            home, guest = np.concatenate(found).T
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(guest)], names=["home", "node"])

    ordered = dealt.repartition(busy_tasks(dealt), "tree", "region", "i", "j").sortWithinPartitions("tree", "region", "i", "j", "side", "node")
    return ordered.mapInArrow(compare, "home long, node long").distinct()


def similar(inter: np.ndarray, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    """Is 100 * intersection at least percent * union, in whole numbers."""
    return 100 * inter >= percent * (a + b - inter)


def set_links(sets: list[np.ndarray], rows: np.ndarray, others: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of a row and another, by counting shared shingles through an index of the others."""
    sizes = np.array([len(s) for s in sets])
    value = np.concatenate([sets[o] for o in others])
    owner = np.repeat(np.arange(len(others)), sizes[others])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    left, right = [], []
    for r in rows:
        lo = np.searchsorted(value, sets[r], side="left")
        n = np.searchsorted(value, sets[r], side="right") - lo
        on = n > 0
        lo, n = lo[on], n[on]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        inter = np.bincount(owner[at], minlength=len(others))
        hit = others[similar(inter, sizes[r], sizes[others], percent) & (others != r)]
        left.append(np.full(len(hit), r))
        right.append(hit)
    return np.concatenate(left), np.concatenate(right)


def within_families(family: DataFrame) -> DataFrame:
    """Pairs of blocks of a family: (family, kind 0, i, j, side, node), side 1 empty where a block meets itself."""
    sizes = family.groupBy("family").agg(F.count("*").alias("size")).filter("size > 1")
    rows = family.join(sizes, "family").withColumn("blocks", F.ceil(F.col("size") / F.lit(SET_BLOCK)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") <= F.col("with"), 0).otherwise(1).alias("side")
    return rows.select("family", F.lit(0).alias("kind"), F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), side, "node")


def with_guests(family: DataFrame, guests: DataFrame) -> DataFrame:
    """Blocks of a family (side 0) and of its guests (side 1), every one with every other: (family, kind 1, i, j, side, node)."""
    come = guests.select(F.col("home").alias("family"), "node")
    counts = come.groupBy("family").agg(F.count("*").alias("guests"))
    # a node in no family is its own
    own = counts.select("family").join(family, "family", "left").select("family", F.coalesce("node", "family").alias("node"))
    sizes = counts.join(own.groupBy("family").agg(F.count("*").alias("size")), "family")
    blocks, groups = (F.ceil(F.col(c) / F.lit(SET_BLOCK)).cast("int") for c in ("size", "guests"))
    sizes = sizes.select("family", blocks.alias("blocks"), groups.alias("groups"))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = own.join(sizes, "family").withColumn("i", deal("blocks")).withColumn("j", every("groups")).withColumn("side", F.lit(0))
    two = come.join(sizes, "family").withColumn("i", every("blocks")).withColumn("j", deal("groups")).withColumn("side", F.lit(1))
    return one.unionByName(two).select("family", F.lit(1).alias("kind"), "i", "j", "side", "node")


def links_in_blocks(texts: DataFrame, dealt: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that join what is connected on full sets within each pair of blocks (texts: node, text)."""
    rows = dealt.join(texts, "node").select("family", "kind", "i", "j", "side", "node", "text")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in whole_groups(batches, 4):
            side, node, kind = (rows.column(c).to_numpy() for c in ("side", "node", "kind"))
            a, b = [], []
            for lo, hi in zip(edges[:-1], edges[1:]):
                first, second = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 1)
                if not len(first) or (kind[lo] == 1 and not len(second)):
                    continue
                sets = list(shingle_sets(rows.column("text").slice(lo, hi - lo), width))
                left, right = set_links(sets, first, second if len(second) else first, percent)
                root = roots(hi - lo, left, right)
                on = np.flatnonzero(root != np.arange(hi - lo))
                a.append(node[lo + root[on]])
                b.append(node[lo + on])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, dtype=np.int64)) for x in (a, b)], names=["a", "b"])

    ordered = rows.repartition(busy_tasks(rows), "family", "kind", "i", "j").sortWithinPartitions("family", "kind", "i", "j", "side", "node")
    return ordered.mapInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs(doc_id, text)``."""
    least = percent / 100 - SLACK
    base = on_cluster_disk(signatures(docs, width))
    usable = base.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = usable.groupBy("key", "key2").agg(F.min_by(F.struct("doc_id", "orders", "sketch"), "doc_id").alias("r"))
    reps = on_cluster_disk(reps.select("key", "key2", F.col("r.doc_id").alias("node"), "r.orders", "r.sketch"))
    # a row for each node, also where rows share a doc_id
    nodes = reps.select("node", "orders", "sketch")
    members = on_cluster_disk(regions(nodes).join(nodes.select("node", "sketch"), "node").select("tree", "region", "node", "sketch", "size"))
    family = on_cluster_disk(families(members, elect(members), least))
    guests = on_cluster_disk(across_families(members, family, least))
    dealt = on_cluster_disk(within_families(family).unionByName(with_guests(family, guests)))
    text = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    wanted = on_cluster_disk(dealt.select("node").distinct())
    near = mark_members(text, "node", wanted, "__wanted").filter("__wanted").drop("__wanted")
    texts = on_cluster_disk(near.join(wanted, "node", "left_semi"))
    links = links_in_blocks(texts, dealt, width, percent)
    shared_ids = usable.select("doc_id", "key", "key2").join(reps.select("key", "key2", "node"), ["key", "key2"])
    copies = shared_ids.select(F.col("node").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")
    names = components(links.unionByName(copies))
    out = base.select("doc_id", "n_shingles").join(names.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shingles of four words, Jaccard similarity 0.8."""
    return near_duplicates(read_documents(spark, sf_dir), width=4, percent=80)
