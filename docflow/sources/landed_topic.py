"""A topic landed as files, read as a stream by partition and offset.

Layout: Parquet files under `path/partition=P/`, with an `offset` column that grows within a partition. The
stream source names ranges of offsets, a small row for each partition and micro-batch, and its position is the
next offset of each partition, so the checkpoint alone decides where a restarted stream goes on. The records
of the ranges are read by Spark itself: partitions are pruned and offsets pushed to the Parquet scan.

Where a new stream starts: ``earliest``, ``latest``, or given offsets by partition, with -2 for the earliest and
-1 for the latest of one partition; a partition without one, also one that appears later, starts at its earliest.
`max_offsets` limits a micro-batch and is shared among the partitions by what each has left. Offsets that are
gone from the files before they were read are an error, not a gap.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.streaming.runner import BatchFn

SOURCE = "docflow_landed_topic"
RANGES = "partition int, from_offset long, until_offset long"


def _source() -> type:
    """The data source class. Spark's planner gets it by value, so it uses nothing outside itself."""
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            import json

            self.path = options["path"].rstrip("/")
            start = options.get("starting", "earliest")
            self.starting = json.loads(start) if start.startswith("{") else start
            self.limit = int(options.get("max_offsets", "0"))
            self.footers = {}

        def bounds(self) -> dict:
            """partition -> (earliest offset, offset after the last), from the footers of the files."""
            import pyarrow.parquet as pq
            from pyarrow import fs

            if "://" in self.path:
                files, path = fs.FileSystem.from_uri(self.path)
            else:
                files, path = fs.LocalFileSystem(), self.path.removeprefix("file:")
            out = {}
            for folder in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                name = folder.base_name
                if not name.startswith("partition=") or not name[10:].isdigit():
                    continue
                for f in files.get_file_info(fs.FileSelector(folder.path)):
                    if not f.base_name.endswith(".parquet") or f.base_name[0] in "._":
                        continue
                    if f.path not in self.footers:
                        with files.open_input_file(f.path) as handle:
                            meta = pq.ParquetFile(handle).metadata
                        at = meta.schema.names.index("offset")
                        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
                        self.footers[f.path] = (min(s.min for s in stats), max(s.max for s in stats) + 1) if stats else None
                    found = self.footers[f.path]
                    if found:
                        low, high = out.get(name[10:], found)
                        out[name[10:]] = (min(low, found[0]), max(high, found[1]))
            return out

        def initialOffset(self) -> dict:
            out = {}
            for p, (low, high) in self.bounds().items():
                given = {"earliest": -2, "latest": -1}[self.starting] if isinstance(self.starting, str) else self.starting.get(p, -2)
                out[p] = low if given == -2 else high if given == -1 else given
            if not isinstance(self.starting, str):  # given offsets of partitions that have no file yet
                out = {**{p: n for p, n in self.starting.items() if n >= 0}, **out}
            return out

        def ranges(self, start: dict, end: dict, bounds: dict) -> list:
            rows = []
            for p in sorted(end, key=int):
                begin = start.get(p, bounds[p][0] if p in bounds else 0)
                if end[p] <= begin:
                    continue
                if p in bounds and begin < bounds[p][0] and p in start:
                    raise ValueError(f"partition {p}: offsets {begin} to {bounds[p][0] - 1} are gone from {self.path}")
                rows.append((int(p), begin, end[p]))
            return rows

        def read(self, start: dict):
            bounds = self.bounds()
            begin = {p: start.get(p, low) for p, (low, _) in bounds.items()}
            left = {p: max(0, high - begin[p]) for p, (_, high) in bounds.items()}
            total = sum(left.values())
            end = dict(start)
            for p in sorted(left, key=int):
                # a share by what is left, rounded up, so every partition with records moves on
                share = left[p] if not self.limit or total <= self.limit else -(-left[p] * self.limit // total)
                end[p] = begin[p] + min(left[p], share)
            return iter(self.ranges(start, end, bounds)), end

        def readBetweenOffsets(self, start: dict, end: dict):
            return iter(self.ranges(start, end, self.bounds()))

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def schema(self) -> str:
            return RANGES

        def simpleStreamReader(self, schema):
            return Reader(self.options)

    return Source


def land(records: DataFrame, path: str) -> None:
    """Append records (partition, offset, ...) to a landed topic."""
    records.write.mode("append").partitionBy("partition").parquet(path)


def topic_ranges(spark: SparkSession, path: str, starting: str | Mapping[int, int] = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Stream of the offset ranges (partition, from_offset, until_offset) of a landed topic.

    With a limit, run it with back-to-back micro-batches (``runner.drain``): an ``availableNow`` run ends after one
    limited batch, and the next run goes on behind it.
    """
    if not isinstance(starting, str):
        starting = json.dumps({str(p): int(n) for p, n in starting.items()})
    elif starting not in ("earliest", "latest"):
        raise ValueError("a topic starts at earliest, latest or given offsets")
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    spark.dataSource.register(_source())
    reader = spark.readStream.format(SOURCE).option("path", path).option("starting", starting)
    return (reader.option("max_offsets", str(max_offsets)) if max_offsets else reader).load()


def _any(conditions: Sequence[Column]) -> Column:
    """Their disjunction, as a tree of small depth."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def records(spark: SparkSession, path: str, ranges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """The records of some offset ranges of a landed topic."""
    topic = spark.read.parquet(path)
    wanted = [(F.col("partition") == p) & (F.col("offset") >= low) & (F.col("offset") < high) for p, low, high in ranges]
    return topic.filter(_any(wanted)) if wanted else topic.limit(0)


def topic_writer(path: str, batch_fn: BatchFn) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over ``topic_ranges``: `batch_fn` gets the records of the micro-batch."""

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        ranges = [tuple(r) for r in batch_df.select("partition", "from_offset", "until_offset").collect()]  # a row for each partition
        if ranges:
            batch_fn(records(batch_df.sparkSession, path, sorted(ranges)), batch_id)

    return fn
