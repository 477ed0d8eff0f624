"""The changes of a keyed store as a stream whose offsets are the store's versions.

``store_versions`` is a stream source with one small row for each published version; its offset is the last
version delivered, so a consumer that restarts from its checkpoint goes on behind it, and versions published while it
was away are delivered in order. The change events themselves are Spark's work: for each version of a micro-batch,
``changes_writer`` joins it with the version before (both bucketed by the key, so without a shuffle)
and hands the events to the consumer's batch function.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.sinks import store_log
from docflow.sinks.keyed_store import committed, read_keyed, store_changes
from docflow.sinks.retention import cursor_path
from docflow.streaming.runner import BatchFn

SOURCE = "docflow_store_versions"


def _source() -> type:
    """The data source class. Spark's planner gets it by value, so it uses nothing outside itself."""
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.root = options["root"].rstrip("/")
            self.begin = int(options.get("start_after", "0"))
            self.limit = int(options.get("max_versions", "0"))

        def published(self) -> list[int]:
            import re

            if "://" in self.root:
                from pyarrow import fs

                files, path = fs.FileSystem.from_uri(self.root)
                found = [i.base_name for i in files.get_file_info(fs.FileSelector(f"{path}/_log", allow_not_found=True))]
            else:
                import os

                path = self.root.removeprefix("file:")
                found = os.listdir(f"{path}/_log") if os.path.isdir(f"{path}/_log") else []
            return sorted(int(m[1]) for m in map(re.compile(r"^(\d{8,})\.json$").match, found) if m)

        def initialOffset(self) -> dict:
            return {"version": self.begin}

        def read(self, start: dict):
            new = [v for v in self.published() if v > start["version"]]
            new = new[: self.limit] if self.limit else new
            return iter([(v,) for v in new]), {"version": new[-1] if new else start["version"]}

        def readBetweenOffsets(self, start: dict, end: dict):
            # a version that retention removed meanwhile is still named: its reader then fails loudly
            return iter([(v,) for v in range(start["version"] + 1, end["version"] + 1)])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def schema(self) -> str:
            return "version long"

        def simpleStreamReader(self, schema):
            return Reader(self.options)

    return Source


def store_versions(spark: SparkSession, root: str, start_after: int = 0, max_versions: int | None = None) -> DataFrame:
    """Stream of the published versions after `start_after`, at most `max_versions` a micro-batch.

    With a limit, run it with back-to-back micro-batches (``runner.drain`` stops it when all is taken): an
    ``availableNow`` run ends after one limited batch, and the next run goes on behind it.
    """
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    spark.dataSource.register(_source())
    reader = spark.readStream.format(SOURCE).option("root", root).option("start_after", str(start_after))
    return (reader.option("max_versions", str(max_versions)) if max_versions else reader).load()


def changes_writer(root: str, key: str, batch_fn: BatchFn, consumer: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over ``store_versions``: `batch_fn` gets (version, operationType, fullDocument).

    The first version that a store still holds is given as inserts of all its documents if it is the store's first;
    otherwise a version whose predecessor is gone raises, and nothing is skipped. With a `consumer` name the version reached
    is kept beside the store after each batch, and retention leaves what the consumer still needs.
    """

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        wanted = sorted(r["version"] for r in batch_df.collect())  # a row for each version
        if not wanted:
            return
        events = [store_changes(spark, root, key, v).select(F.lit(v).cast("long").alias("version"), "operationType", "fullDocument") for v in wanted]
        batch_fn(reduce(DataFrame.unionByName, events), batch_id)
        if consumer is not None:
            store_log.write_text(spark, cursor_path(root, consumer), json.dumps({"version": wanted[-1]}))

    return fn


def snapshot(spark: SparkSession, root: str, key: str) -> tuple[int, DataFrame]:
    """(version, its documents as inserts): where a new consumer of an old store begins; the stream goes on after that version."""
    held = committed(spark, root)
    if not held:
        raise ValueError(f"{root} holds no version")
    rows = read_keyed(spark, root, key, held[-1].version)
    return held[-1].version, rows.select(F.lit(held[-1].version).cast("long").alias("version"), F.lit("insert").alias("operationType"), F.struct(*rows.columns).alias("fullDocument"))
