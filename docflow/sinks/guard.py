"""Idempotent appends to a keyed table that has no MERGE (e.g. a JDBC table).

A micro-batch replayed after a failure must not add its rows twice. For a single
writer, append only the rows whose key is not in the target yet: keep the latest
row per key within the batch, then anti-join the target's keys. The delta is
materialised with a reliable ``checkpoint()`` (files in ``spark.checkpoint.dir``)
before the write, since re-evaluating the anti-join after the append would read
the changed target and find nothing to write on a task retry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import shared_root
from docflow.sinks.jdbc import write_jdbc


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `order_by` (aggregate, map-side combined)."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order_by])).alias("__r"))
    return picked.select(key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def new_keys_only(batch: DataFrame, target_keys: DataFrame, key: str) -> DataFrame:
    """Rows of `batch` whose key is absent from `target_keys` (left anti join, shuffle on key)."""
    return batch.join(target_keys.select(key).distinct(), on=key, how="left_anti")


def guarded_delta(
    spark: SparkSession, batch: DataFrame, target_keys: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    shared_root(spark)  # make sure a checkpoint folder is configured
    return new_keys_only(latest_per_key(batch, key, order_by), target_keys, key).checkpoint(eager=True)


def jdbc_batch_writer(
    url: str,
    table: str,
    key: str,
    order_by: Sequence[str],
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
    batchsize: int | None = None,
    read_options: Mapping[str, str] | None = None,
):
    """foreachBatch function: guarded, idempotent JDBC append (single writer per table).

    The guard reads the target's key column each batch; for a large target pass
    `read_options` (``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``) so that scan runs in parallel.
    """

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in {**(properties or {}), **(read_options or {})}.items():
            reader = reader.option(k, v)
        target_keys = reader.load().select(key)
        delta = guarded_delta(spark, batch_df, target_keys, key, order_by)
        write_jdbc(delta, url, table, "append", properties, num_partitions, batchsize)

    return fn
