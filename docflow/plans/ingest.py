"""Crawl ingest: landed API pages -> keyed document store -> change feed.

Each crawl is one batch of pages taken at one time. Items are unwrapped from their pages
with every field they carry and upserted by `_id` with ``$set`` meaning: a field of a later
item replaces the stored one (an explicit null too), an absent field keeps it, and
first-insert and last-update times are kept. The store holds the whole document as a map
(`doc`) and the declared fields beside it as typed columns, which readers can prune.
``docflow.sinks.keyed_store.store_changes`` gives the change events of a version. Pages and
items that cannot be stored go to a quarantine folder beside the store, never nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow.operators.upsert import INSERTED, UPDATED, fold_batches, merge_open, roll_up_open
from docflow.sources.pages import decode_pages, page_items, split_items, typed_field


def crawl_documents(
    pages: DataFrame, doc_schema: StructType, crawl_time: Column, seq: int, key: str = "_id"
) -> tuple[DataFrame, DataFrame]:
    """One crawl's (items with its time, quarantine); `seq` orders items within the crawl by page."""
    docs, bad = page_items(pages, doc_schema, key=key)
    return docs.withColumn("__t", crawl_time).withColumn("__seq", F.lit(seq)), bad


def _state(df: DataFrame, key: str) -> DataFrame:
    """What merging needs of a stored version."""
    return df.select(key, "doc", INSERTED, UPDATED)


def with_fields(state: DataFrame, doc_schema: StructType, fields: Sequence[str], key: str = "_id") -> DataFrame:
    """Rolled-up documents with the declared fields as typed columns."""
    types = {f.name: f.dataType for f in doc_schema.fields}
    typed = [typed_field(F.col("doc"), f, types[f]).alias(f) for f in fields]
    return state.select(key, *typed, INSERTED, UPDATED, "doc")


def ingest_crawls(
    crawls: Sequence[tuple[DataFrame, Column]],
    doc_schema: StructType,
    fields: Sequence[str],
    store: DataFrame | None = None,
    key: str = "_id",
    quarantine: str | None = None,
) -> DataFrame:
    """Fold crawls (in order) into the store. Returns the new store contents.

    Within a crawl, when the same id appears on two pages, the later page's fields win. Pages and
    items that cannot be stored go to the folder `quarantine`, one subfolder for each crawl (by
    default a fresh one under the shared folder).
    """
    from docflow.session import scratch_path
    from docflow.sinks.files import write_batch

    docs = []
    for i, (pages, t) in enumerate(crawls):
        items, bad = crawl_documents(pages, doc_schema, t, i, key)
        quarantine = quarantine or scratch_path(pages.sparkSession, "crawls_quarantine")
        write_batch(bad, quarantine, i)
        docs.append(items)
    state = fold_batches(
        docs,
        lambda d: roll_up_open(d, key, "doc", ["__t", "__seq", "page"], "__t"),
        lambda t, d: merge_open(t, d, key),
        initial=None if store is None else _state(store, key),
    )
    return with_fields(state, doc_schema, fields, key)


def _store(spark, root: str, pages: DataFrame, keep: tuple[str, ...], doc_schema, fields, order_by, time_col, key, buckets, transaction=None) -> int:
    """Upsert landed pages; each body is decoded once, for the items and the quarantine."""
    from docflow.sinks.files import write_batch
    from docflow.sinks.keyed_store import committed, is_replay, upsert_keyed

    held = committed(spark, root)
    if transaction is not None and is_replay(spark, root, transaction):
        return held[-1].version
    decoded = decode_pages(pages, keep=keep).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        docs, bad = split_items(decoded, doc_schema, keep, key=key)
        number = transaction[1] if transaction is not None else (held[-1].version if held else 0) + 1
        write_batch(bad, f"{quarantine_path(root)}/stream={quote(transaction[0], safe='') if transaction is not None else 'batch'}", number)
        rolled = with_fields(roll_up_open(docs, key, "doc", order_by, time_col), doc_schema, fields, key)

        def combine(current: DataFrame, delta: DataFrame) -> DataFrame:
            return with_fields(merge_open(_state(current, key), _state(delta, key), key), doc_schema, fields, key)

        return upsert_keyed(spark, root, rolled, key, fields, buckets, combine=combine, transaction=transaction)
    finally:
        decoded.unpersist()


def quarantine_path(root: str) -> str:
    """Folder of what the upserts into the store at `root` could not store: `stream=S/batch_id=N`, by batch
    of a stream, or by version for crawls ingested in batch."""
    return root.rstrip("/") + "_quarantine"


def ingest_crawl_into_store(
    spark,
    root: str,
    pages: DataFrame,
    doc_schema: StructType,
    fields: Sequence[str],
    crawl_time: Column,
    seq: int = 0,
    key: str = "_id",
    buckets: int | None = None,
) -> int:
    """Unwrap one crawl, roll it up per key and upsert it into the bucketed keyed store."""
    timed = pages.withColumns({"__t": crawl_time, "__seq": F.lit(seq)})
    return _store(spark, root, timed, ("page", "__t", "__seq"), doc_schema, fields, ["__t", "__seq", "page"], "__t", key, buckets)


def pages_batch_writer(
    root: str,
    doc_schema: StructType,
    fields: Sequence[str],
    time_col: str = "crawled_at",
    key: str = "_id",
    buckets: int | None = None,
    stream_id: str | None = None,
):
    """foreachBatch function: landed pages (page, `time_col`, body) -> keyed store upsert.

    Items are ordered by (crawl time, page) within the batch. The version carries (stream id, batch id), so a
    replayed batch is recognised: it gives no new version and no second quarantine copy. The
    stream id is by default the id of the running query, which its checkpoint keeps over restarts (a new
    checkpoint counts batches from 0 again and is another stream); outside a query it is `direct`.
    """

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        stream = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        _store(spark, root, batch_df, ("page", time_col), doc_schema, fields, [time_col, "page"], time_col, key, buckets, (stream, batch_id))

    return fn
