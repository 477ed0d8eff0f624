"""Run a document stream through a per-batch function with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docflow.operators.decode import as_text, parse, split_parsed
from docflow.sinks.files import write_batch

BatchFn = Callable[[DataFrame, int], None]


def run_stream(
    source: DataFrame,
    batch_fn: BatchFn,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start `source` -> foreachBatch(`batch_fn`), append mode, checkpoint at `checkpoint`.

    `trigger`: kwargs for ``DataStreamWriter.trigger`` (None = back-to-back batches,
    ``{"availableNow": True}`` = drain what is there and stop). Restarting with the
    same checkpoint resumes after the last committed batch. The caller waits/stops.
    """
    w = source.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def drain(query: StreamingQuery) -> None:
    """Let a query with back-to-back micro-batches take all that is there, then stop it; its error is raised here.

    For sources with a limit a micro-batch of their own (``store_versions``, ``topic_ranges``), which under
    ``availableNow`` plan the end once and stop after the first limited batch.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def decode_to(
    schema: StructType,
    write_valid: BatchFn,
    quarantine_path: str,
    key: str = "_id",
    fmt: str = "parquet",
) -> BatchFn:
    """Batch function: decode once, hand the valid documents to `write_valid`, keep the rest in the quarantine.

    The quarantine replaces its `batch_id=N` folder. The parsed batch is persisted (memory, then
    disk) so the text is decoded once for the two writes; a lost block is recomputed from the
    source offsets.
    """

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        text = as_text(batch_df, "value")  # a raw Kafka frame carries `value` as BINARY
        parsed = parse(text, schema, "value", keep_raw=True, key=key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, quarantine = split_parsed(parsed, key)
            write_valid(valid, batch_id)
            write_batch(quarantine, quarantine_path, batch_id, fmt)
        finally:
            parsed.unpersist()

    return fn


def decode_to_files(
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    out_path: str,
    quarantine_path: str,
    key: str = "_id",
    fmt: str = "parquet",
) -> BatchFn:
    """``decode_to`` with transform(valid) as files; a replayed batch id yields the same table."""
    return decode_to(schema, lambda valid, batch_id: write_batch(transform(valid), out_path, batch_id, fmt), quarantine_path, key, fmt)


def decode_to_jdbc(
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    writer: BatchFn,
    quarantine_path: str,
    key: str = "_id",
) -> BatchFn:
    """``decode_to`` with transform(valid) handed to a table writer (``docflow.sinks.guard.jdbc_batch_writer``)."""
    return decode_to(schema, lambda valid, batch_id: writer(transform(valid), batch_id), quarantine_path, key)
