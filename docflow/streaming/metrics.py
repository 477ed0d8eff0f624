"""Counts of each micro-batch, taken in the passes that write it.

``observe`` adds the counts to the write jobs themselves, so no job runs for a metric. They are kept as one row for each
batch (a replay replaces its row), and a listener collects what Spark reports of the same batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from docflow.operators.decode import as_text, parse, split_parsed
from docflow.sinks.files import write_batch
from docflow.streaming.runner import BatchFn

METRICS = "valid long, quarantined long, written long"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, and the number of its rows as ``count`` once an action has run over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("count")), seen


def decode_with_metrics(schema: StructType, transform: Callable[[DataFrame], DataFrame], out_path: str, quarantine_path: str, metrics_path: str, key: str = "_id", fmt: str = "parquet") -> BatchFn:
    """``decode_to_files`` that also keeps valid, quarantined and written rows of each batch in `metrics_path/batch_id=N`."""

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        parsed = parse(as_text(batch_df, "value"), schema, "value", keep_raw=True, key=key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, quarantine = split_parsed(parsed, key)
            valid, n_valid = counted(valid, f"valid_{batch_id}")
            rows, n_written = counted(transform(valid), f"written_{batch_id}")
            write_batch(rows, out_path, batch_id, fmt)
            quarantine, n_bad = counted(quarantine, f"quarantined_{batch_id}")
            write_batch(quarantine, quarantine_path, batch_id, fmt)
            row = tuple(int(n.get["count"]) for n in (n_valid, n_bad, n_written))
            write_batch(batch_df.sparkSession.createDataFrame([row], METRICS), metrics_path, batch_id, fmt)
        finally:
            parsed.unpersist()

    return fn


class BatchProgress(StreamingQueryListener):
    """Listener that keeps, for each query and batch, the input rows and the observed metrics of the stream itself."""

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], dict] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.batches[str(p.id), p.batchId] = {"input": p.numInputRows, **{name: row.asDict() for name, row in p.observedMetrics.items()}}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception
