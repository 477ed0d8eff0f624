"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship_package(spark: SparkSession) -> None:
    """Send this package to every executor, once for each Spark context (a few dozen small files)."""
    context = spark.sparkContext
    if any(f.rpartition("/")[2].startswith("docflow-") for f in context.listFiles):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="docflow-")) / f"docflow-{uuid.uuid4().hex[:8]}.zip"  # served by the driver
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def label_fold(doc_id, modulus: int):
    """Fold of a document: crc32 of its id written as text, modulo ``modulus`` (null id: fold of '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def on_cluster_disk(df: DataFrame) -> DataFrame:
    """Materialise once in spark.checkpoint.dir; a lost executor costs no recomputation."""
    from docflow.session import shared_root

    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches cut so that no group crosses a border: (rows, edges of the groups among them).

    Groups are runs of equal values in the first ``keys`` columns (whole numbers). What is
    held back is one group, so the caller must bound their size.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in range(keys)):
            start = 0
        elif held:
            yield _joined(held), np.array([0, sum(b.num_rows for b in held)])
            held, start = [], 0
        else:
            start = 0
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in range(keys):
            change |= np.diff(batch.column(k).to_numpy(zero_copy_only=False)) != 0
        edges = np.flatnonzero(change) + 1
        if not len(edges):
            held.append(batch)
            continue
        if held:
            rows = _joined([*held, batch.slice(0, edges[0])])
            yield rows, np.array([0, rows.num_rows])
            start, edges = edges[0], edges[1:]
        if len(edges):
            yield batch.slice(start, edges[-1] - start), np.r_[0, edges - start]
            start = edges[-1]
        held = [batch.slice(start)]
    if held:
        rows = _joined(held)
        yield rows, np.array([0, rows.num_rows])


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


#: Bits of a membership filter: 2**18 words of 64 bits at most, whatever the number of ids.
FILTER_BITS = 24


def mark_members(df: DataFrame, key: str, ids: DataFrame, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if ``key`` is surely not among the ids (one column of that name).

    A bit table of fixed size, built by an aggregate and broadcast, so rows that a join would
    drop need no shuffle. With very many ids it lets more rows through, and the exact join behind it does the work.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << FILTER_BITS))
    word = F.shiftright(slot, 6).cast("int").alias("__word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    table = ids.filter(F.col(key).isNotNull()).select(word, bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    marked = df.withColumn("__word", word).join(F.broadcast(table), "__word", "left")
    hit = F.col(key).isNotNull() & (F.coalesce(F.col("__bits"), F.lit(0)).bitwiseAND(bit) != 0)
    return marked.select(*df.columns, hit.alias(out))
