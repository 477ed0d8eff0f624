"""Near duplicates among embeddings: random-hyperplane signs in several tables, exact cosines, components.

Equal vectors become one class first, so a group of copies is one vector with a weight. Every
class gets one code per table, the signs of its products with a table's random hyperplanes. The
number of signs follows from the number of classes, so that a bucket holds about
``BUCKET`` vectors by chance at any size; the number of tables follows from the signs and the recall
asked for at the threshold. Vectors with the same code in a table are compared in double precision.
A crowded bucket is cut into blocks of at most ``BLOCK`` vectors, and each pair of blocks is a task
group of its own. A pair that meets in several tables counts in the first one only. A group
returns, for each vector with links in it, the weight of its partners and one link towards its
local component, so the output never holds all pairs.

Defined results: a null, empty or zero vector, or one with null or non-finite components, links with
nothing and is its own component; vectors of different length do not link; a repeated row counts
as another equal vector; rows that share a vec_id count as linked; a null vec_id has no component
and is not kept; an empty table gives no rows; other columns, labels too, are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from docflow.llm.common import on_cluster_disk, read_table
from docflow.llm.components import components

BUCKET = 64
BLOCK = 1024
SEED = 11


def tables_for(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs per table, and tables, for ``recall`` of pairs that are just at the threshold."""
    bits = min(24, max(4, round(math.log2(max(classes, 1) / BUCKET)))) if classes > BUCKET else 4
    same = (1.0 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1.0 - recall) / math.log(1.0 - same)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so no square overflows or vanishes."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(classes: DataFrame, width: int, bits: int, tables: int) -> DataFrame:
    """``codes``: array with one code for each table (vectors of one length)."""
    schema = StructType([*classes.schema.fields, StructField("codes", ArrayType(LongType(), False))])
    at = classes.columns.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.Generator(np.random.PCG64([SEED, width])).standard_normal((width, bits * tables))
        values = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            signs = (_matrix(batch.column(at), width) @ planes > 0).reshape(-1, tables, bits)
            flat = (signs * values).sum(axis=2).ravel()
            edges = np.arange(batch.num_rows + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(edges), pa.array(flat), type=pa.list_(pa.field("element", pa.int64(), False)))], names=schema.names)

    return classes.mapInArrow(run, schema)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes, for links given as two index arrays."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def link_block(table: int, first: np.ndarray, x: np.ndarray, code: np.ndarray, weight: np.ndarray, ids: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Links of a group. first: in the group's first block; only pairs across the blocks, or within one block if all are first."""
    own = np.flatnonzero(first)
    other = np.flatnonzero(~first)
    alone = not len(other)
    if alone:
        other = own
    left, right = [], []
    step = 256
    for lo in range(0, len(own), step):
        rows = own[lo : lo + step]
        i, j = np.nonzero(x[rows] @ x[other].T >= threshold)
        i, j = rows[i], other[j]
        if alone:
            i, j = i[i < j], j[i < j]
        earlier = (code[i, :table] == code[j, :table]).any(axis=1)
        left.append(i[~earlier])
        right.append(j[~earlier])
    left = np.concatenate(left) if left else np.empty(0, dtype=np.int64)
    right = np.concatenate(right) if right else np.empty(0, dtype=np.int64)
    links = np.bincount(left, weights=weight[right], minlength=len(ids)) + np.bincount(right, weights=weight[left], minlength=len(ids))
    on = np.flatnonzero(links)
    return ids[on], links[on].astype(np.int64), ids[roots(len(ids), left, right)[on]]


def link_classes(classes: DataFrame, width: int, threshold: float, recall: float) -> DataFrame:
    """(node, links, other) rows: weight of a class's partners in a group, and a class it is connected with."""
    spark = classes.sparkSession
    total = classes.count()
    bits, tables = tables_for(total, threshold, recall)
    coded = on_cluster_disk(codes(classes, width, bits, tables))
    rows = coded.select("node", "weight", "embedding", "codes", F.posexplode("codes").alias("t", "code"))
    sizes = coded.select(F.posexplode("codes").alias("t", "code")).groupBy("t", "code").agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    rows = rows.join(sizes, ["t", "code"]).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - F.lit(1))))
    rows = rows.select("t", "code", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") <= F.col("with")).alias("first"), "node", "weight", "embedding", "codes")

    def link(key: tuple, group: pa.Table) -> pa.Table:
        column = {n: group.column(n).combine_chunks() for n in ("first", "node", "weight", "embedding", "codes")}
        x = _matrix(column["embedding"], width)
        code = np.asarray(column["codes"].flatten()).reshape(len(x), -1)
        first = column["first"].to_numpy(zero_copy_only=False)
        node, links, other = link_block(key[0].as_py(), first, x, code, column["weight"].to_numpy(), column["node"].to_numpy(), threshold)
        return pa.table({"node": node, "links": links, "other": other})

    return spark.createDataFrame([], "node long, links long, other long") if not total else rows.groupBy("t", "code", "i", "j").applyInArrow(link, "node long, links long, other long")


def near_embeddings(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.97) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding)``."""
    e = F.col("embedding")
    as_double = F.transform(e, lambda v: v.cast("double"))
    finite = F.forall(as_double, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(as_double, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(usable, F.lit(False)).alias("usable"), "embedding")
    rows = rows.withColumn("key", F.when(F.col("usable"), F.xxhash64("embedding"))).withColumn("key2", F.when(F.col("usable"), F.hash("embedding")))
    equal = rows.filter("usable").groupBy("key", "key2").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.min_by("embedding", "vec_id").alias("embedding"))
    equal = on_cluster_disk(equal.withColumn("width", F.size("embedding")))
    parts = None
    for (width,) in sorted(equal.select("width").distinct().collect()):  # one length, as a rule
        own = link_classes(equal.filter(F.col("width") == width).select("node", "weight", "embedding"), width, threshold, recall)
        parts = own if parts is None else parts.unionByName(own)
    if parts is None:
        parts = vectors.sparkSession.createDataFrame([], "node long, links long, other long")
    parts = on_cluster_disk(parts)
    linked = parts.groupBy("node").agg(F.sum("links").alias("links"))
    names = components(parts.select(F.col("node").alias("a"), F.col("other").alias("b")))
    equal = equal.select("key", "key2", "node", "weight").join(linked, "node", "left").join(names, "node", "left")
    equal = equal.select("key", "key2", (F.col("weight") - F.lit(1) + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "node").alias("component"))
    out = rows.select("vec_id", "key", "key2").join(equal, ["key", "key2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.9."""
    return near_embeddings(read_table(spark, sf_dir, "embeddings"))
