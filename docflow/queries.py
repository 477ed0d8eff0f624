"""Registered queries: one per operator / plan, each over the whole driver tables.

Each callable takes (spark, sf_dir) and returns a DataFrame whose columns match the
DuckDB oracle in ``docflow.oracle``. Queries that exercise a sink or a stream write
to a fresh folder under the session's ``spark.checkpoint.dir`` and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.operators.decode import decode_column, decode_documents
from docflow.operators.flatten import attach_text, collect_concat, explode_elements, flatten_text
from docflow.operators.upsert import apply_batches, roll_up
from docflow.plans.companies import companies_table
from docflow.plans.jobs import jobs_batch_table, jobs_table
from docflow.schemas import COMPANY_SCHEMA, JOB_FIELDS_USED, JOB_SCHEMA, JOBS_STREAM_COLUMNS, prune
from docflow.session import scratch_path
from docflow.sinks.files import BATCH_COL, JSON_TIME_OPTIONS, write_jsonl
from docflow.sources import driver_tables as dt
from docflow.sources.collection import scan_collection
from docflow.sources.feed import insert_feed
from docflow.sources.pages import page_unwrap
from docflow.sources.stream import stream_documents
from docflow.streaming.runner import decode_to_files, run_stream

# Batch cut points for the incremental upserts (arrival order of the history).
CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
# Field names set by the partial documents (the event types of the history).
EVENT_FIELDS = ("click", "error", "purchase", "signup", "view")
# The part of a job document that the jobs tables read; the parser skips the rest.
JOBS_READ = prune(JOB_SCHEMA, JOB_FIELDS_USED)
# Crawl times for page ingest.
CRAWL_TIMES = ("2024-02-01 00:00:00", "2024-02-02 00:00:00")

COMPANY_API_DOC = StructType(
    [
        StructField("id", LongType()),
        StructField("display_name", StringType()),
        StructField("company_size", StringType()),
        StructField("nationalities_str", StringType()),
    ]
)


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _job_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job documents in wire form, decoded with the fixed schema. The rest is rows of ``q_batch_quarantine``."""
    docs, _ = decode_documents(dt.job_json(spark, sf_dir), JOB_SCHEMA)
    return docs


def _cut(df: DataFrame, ts: str = "ts") -> list[DataFrame]:
    """Split a history into consecutive time ranges (every row in exactly one; a NULL
    time goes with the first range)."""
    t = F.col(ts)
    bounds = [None, *[_ntz(c) for c in CUTS], None]
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (t >= lo)
        if hi is not None:
            cond = cond & (t < hi)
        if lo is None:
            cond = cond | t.isNull()
        out.append(df.filter(cond))
    return out


# ------------------------------------------------------------ decode / flatten

def q_json_decode(spark, sf_dir):
    ev = dt.event_history(spark, sf_dir).select("event_id", "props")
    return decode_column(ev, "props", "k INT", "p").select("event_id", F.col("p.k").alias("k"))


def q_flatten_left(spark, sf_dir):
    docs = flatten_text(_job_docs(spark, sf_dir), "requirements_arr", "requirement", missing="null")
    return docs.select(F.col("_id").alias("id"), "requirement")


def q_flatten_inner(spark, sf_dir):
    return jobs_batch_table(_job_docs(spark, sf_dir))


def q_salary_label(spark, sf_dir):
    return jobs_table(_job_docs(spark, sf_dir)).select("id", "salary")


def q_epoch_millis(spark, sf_dir):
    return jobs_table(_job_docs(spark, sf_dir)).select("id", "inserted_at", "updated_at")


def q_explode_requirements(spark, sf_dir):
    ex = explode_elements(_job_docs(spark, sf_dir), "_id", "requirements_arr")
    return ex.select(F.col("_id").alias("id"), F.col("pos").cast("long").alias("pos"), F.col("text").alias("requirement"))


def q_collect_concat(spark, sf_dir):
    ex = explode_elements(_job_docs(spark, sf_dir), "_id", "requirements_arr")
    return collect_concat(ex, "_id", "text", out="requirement").select(F.col("_id").alias("id"), "requirement")


def q_left_join_details(spark, sf_dir):
    """The reference's shape: explode + ordered aggregate + left join, per array."""
    docs = _job_docs(spark, sf_dir)
    req = collect_concat(explode_elements(docs, "_id", "requirements_arr"), "_id", "text", out="requirement")
    ben = collect_concat(explode_elements(docs, "_id", "benefits"), "_id", "text", out="benefit")
    out = attach_text(attach_text(docs.select("_id", "title"), req, "_id", "left"), ben, "_id", "left")
    return out.select(F.col("_id").alias("id"), "title", "requirement", "benefit")


# ------------------------------------------------------------------ companies

def q_company_projection(spark, sf_dir):
    return companies_table(spark, dt.company_documents(spark, sf_dir), view="companies_docs")


def q_scan_collection(spark, sf_dir):
    """Collection landed as JSON files, scanned with the fixed schema, then projected in SQL."""
    path = scratch_path(spark, "companies_jsonl")
    write_jsonl(dt.company_documents(spark, sf_dir), path)
    docs = scan_collection(spark, "json", path, schema=COMPANY_SCHEMA, options=JSON_TIME_OPTIONS, view="companies_scan")
    return companies_table(spark, docs, view="companies_scan")


# --------------------------------------------------------------- feed / pages

def q_insert_feed(spark, sf_dir):
    feed = insert_feed(dt.change_events(spark, sf_dir))
    return feed.select("_id", "event_id", "event_type", "ts")


def q_page_unwrap(spark, sf_dir):
    customer = dt.read_table(spark, sf_dir, "customer")
    pages = dt.api_pages(dt.company_api_docs(customer))
    return page_unwrap(pages, COMPANY_API_DOC).select("_id", "display_name", "page")


def q_ingest_pages(spark, sf_dir):
    """Two crawls into the bucketed keyed store: the second re-lists companies with a
    non-positive balance under a new name; latest crawl wins, first insert kept."""
    from docflow.plans.ingest import ingest_crawl_into_store
    from docflow.sinks.keyed_store import read_keyed

    customer = dt.read_table(spark, sf_dir, "customer")
    crawl1 = dt.api_pages(dt.company_api_docs(customer))
    crawl2 = dt.api_pages(dt.company_api_docs(customer.filter(F.col("c_acctbal") <= 0), rename_segment=True))
    fields = ["display_name", "company_size", "nationalities_str"]
    root = scratch_path(spark, "company_store")
    for seq, (pages, t) in enumerate(((crawl1, CRAWL_TIMES[0]), (crawl2, CRAWL_TIMES[1]))):
        ingest_crawl_into_store(spark, root, pages, COMPANY_API_DOC, fields, _ntz(t), seq)
    return read_keyed(spark, root, "_id").select("_id", *fields, "inserted_at", "updated_at")


# --------------------------------------------------------------------- upsert

UPSERT_FIELDS = ("event_type", "value", "props")


def q_upsert_latest(spark, sf_dir):
    ev = dt.event_history(spark, sf_dir)
    return roll_up(ev, "user_id", UPSERT_FIELDS, ["ts", "event_id"], "ts")


def q_upsert_incremental(spark, sf_dir):
    """History applied in three arrival batches to the bucketed keyed store (U1 + K4)."""
    from docflow.sinks.keyed_store import read_keyed, upsert_keyed

    root = scratch_path(spark, "user_store")
    for part in _cut(dt.event_history(spark, sf_dir)):
        r = roll_up(part, "user_id", UPSERT_FIELDS, ["ts", "event_id"], "ts")
        upsert_keyed(spark, root, r, "user_id", UPSERT_FIELDS)
    return read_keyed(spark, root, "user_id").select("user_id", *UPSERT_FIELDS, "inserted_at", "updated_at")


def q_upsert_fields(spark, sf_dir):
    upd = dt.field_updates(spark, sf_dir).withColumn("m", F.from_json("doc", "map<string,string>"))
    state = apply_batches(_cut(upd), "user_id", "m", EVENT_FIELDS, ["ts", "event_id"], "ts")
    return state.select(
        "user_id", *[F.col(f).cast("long").alias(f) for f in EVENT_FIELDS], "inserted_at", "updated_at"
    )


# ------------------------------------------------------- streams and sinks

def _land_as_text(spark: SparkSession, docs_json: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    docs_json.write.mode("overwrite").text(path)
    return path


def _drain(spark, landed: str, batch_fn, name: str, max_files: int | None = None) -> None:
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else None
    src = stream_documents(spark, "text", landed, options=opts)
    q = run_stream(src, batch_fn, scratch_path(spark, name + "_chk"), trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def q_jobs_stream(spark, sf_dir):
    """Flagship: JSON documents as a file stream -> per-batch decode + flatten -> idempotent Parquet."""
    landed = _land_as_text(spark, dt.job_json(spark, sf_dir), "jobs_landed")
    out, bad = scratch_path(spark, "jobs_out"), scratch_path(spark, "jobs_quarantine")
    _drain(spark, landed, decode_to_files(JOBS_READ, jobs_table, out, bad), "jobs")
    return spark.read.parquet(out).drop(BATCH_COL).select(*JOBS_STREAM_COLUMNS)


def q_stream_documents(spark, sf_dir):
    landed = _land_as_text(spark, dt.job_json(spark, sf_dir), "docs_landed")
    out, bad = scratch_path(spark, "docs_out"), scratch_path(spark, "docs_quarantine")

    def project(docs: DataFrame) -> DataFrame:
        return docs.select(F.col("_id").alias("id"), "title", "content", "owned_id", F.col("detail_url").alias("url"))

    _drain(spark, landed, decode_to_files(JOB_SCHEMA, project, out, bad), "docs")
    return spark.read.parquet(out).drop(BATCH_COL)


def q_jsonl_sink(spark, sf_dir):
    path = scratch_path(spark, "jobs_jsonl")
    table = jobs_table(_job_docs(spark, sf_dir))
    write_jsonl(table, path)
    return spark.read.schema(table.schema).options(**JSON_TIME_OPTIONS).json(path).select(*JOBS_STREAM_COLUMNS)


def q_jobs_batch(spark, sf_dir):
    """The flagship transform in batch form (what ``entry`` returns)."""
    docs, _ = decode_documents(dt.job_json(spark, sf_dir), JOBS_READ)
    return jobs_table(docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_decode": q_json_decode,
    "flatten_left": q_flatten_left,
    "flatten_inner": q_flatten_inner,
    "salary_label": q_salary_label,
    "epoch_millis": q_epoch_millis,
    "explode_requirements": q_explode_requirements,
    "collect_concat": q_collect_concat,
    "left_join_details": q_left_join_details,
    "company_projection": q_company_projection,
    "scan_collection": q_scan_collection,
    "insert_feed": q_insert_feed,
    "page_unwrap": q_page_unwrap,
    "ingest_pages": q_ingest_pages,
    "upsert_latest": q_upsert_latest,
    "upsert_incremental": q_upsert_incremental,
    "upsert_fields": q_upsert_fields,
    "jobs_batch": q_jobs_batch,
    "jobs_stream": q_jobs_stream,
    "stream_documents": q_stream_documents,
    "jsonl_sink": q_jsonl_sink,
}




def q_inner_join_requirements(spark, sf_dir):
    """Batch jobs table through explode + ordered aggregate + SQL INNER JOIN."""
    from docflow.plans.jobs import jobs_batch_sql

    return jobs_batch_sql(spark, _job_docs(spark, sf_dir), jobs_view="jobs_docs", req_view="jobs_requirements")


QUERIES["inner_join_requirements"] = q_inner_join_requirements


def q_upsert_open_fields(spark, sf_dir):
    """Field-level upsert without a declared field list: map roll-ups merged per batch."""
    from docflow.operators.upsert import merge_open, roll_up_open

    from docflow.operators.upsert import fold_batches

    upd = dt.field_updates(spark, sf_dir).withColumn("m", F.from_json("doc", "map<string,string>"))
    state = fold_batches(
        _cut(upd),
        lambda b: roll_up_open(b, "user_id", "m", ["ts", "event_id"], "ts"),
        lambda t, d: merge_open(t, d, "user_id"),
    )
    fields = state.select("user_id", F.explode("doc").alias("field", "value"), "inserted_at", "updated_at")
    return fields.withColumn("value", F.col("value").cast("long"))


QUERIES["upsert_open_fields"] = q_upsert_open_fields


def q_ingest_pages_stream(spark, sf_dir):
    """Crawls landed as JSON-lines page files, streamed into the keyed store batch by batch."""
    from pyspark.sql.types import IntegerType, TimestampNTZType

    from docflow.plans.ingest import pages_batch_writer
    from docflow.sinks.keyed_store import read_keyed
    from docflow.sources.stream import stream_records

    customer = dt.read_table(spark, sf_dir, "customer")
    crawls = [
        dt.api_pages(dt.company_api_docs(customer)),
        dt.api_pages(dt.company_api_docs(customer.filter(F.col("c_acctbal") <= 0), rename_segment=True)),
    ]
    landing, root = scratch_path(spark, "pages_landing"), scratch_path(spark, "company_store_stream")
    fields = ["display_name", "company_size", "nationalities_str"]
    schema = StructType(
        [StructField("page", IntegerType()), StructField("crawled_at", TimestampNTZType()), StructField("body", StringType())]
    )
    chk = scratch_path(spark, "pages_chk")
    for i, (pages, t) in enumerate(zip(crawls, CRAWL_TIMES)):
        write_jsonl(pages.withColumn("crawled_at", _ntz(t)), f"{landing}/crawl={i}")
        src = stream_records(spark, "json", schema, f"{landing}/*", options=JSON_TIME_OPTIONS)
        q = run_stream(src, pages_batch_writer(root, COMPANY_API_DOC, fields), chk, trigger={"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_keyed(spark, root, "_id").select("_id", *fields, "inserted_at", "updated_at")


QUERIES["ingest_pages_stream"] = q_ingest_pages_stream


def q_insert_feed_stream(spark, sf_dir):
    """Change events landed as JSON lines, streamed through the insert-only feed."""
    from docflow.sources.stream import stream_records

    events = dt.change_events(spark, sf_dir)
    landing, out = scratch_path(spark, "changes_landing"), scratch_path(spark, "feed_out")
    write_jsonl(events, landing)
    feed = insert_feed(stream_records(spark, "json", events.schema, landing, options=JSON_TIME_OPTIONS))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        from docflow.sinks.files import write_batch

        write_batch(batch_df.select("_id", "event_id", "event_type", "ts"), out, batch_id)

    q = run_stream(feed, write, scratch_path(spark, "feed_chk"), trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).drop(BATCH_COL)


QUERIES["insert_feed_stream"] = q_insert_feed_stream


def q_stream_quarantine(spark, sf_dir):
    """Binary payloads (as a topic delivers them): jobs, and event records that carry no `_id`.
    Valid documents and the quarantine, both as written by the stream."""
    from docflow.sources.stream import stream_records

    events = dt.event_history(spark, sf_dir)
    keyless = events.select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    payload = dt.job_json(spark, sf_dir).unionByName(keyless).select(F.col("value").cast("binary").alias("value"))
    landed = scratch_path(spark, "payload_landed")
    payload.write.parquet(landed)
    out, bad = scratch_path(spark, "payload_out"), scratch_path(spark, "payload_quarantine")
    src = stream_records(spark, "parquet", payload.schema, landed)
    fn = decode_to_files(JOB_SCHEMA, lambda docs: docs.select(F.col("_id").alias("id")), out, bad)
    _finish(run_stream(src, fn, scratch_path(spark, "payload_chk"), trigger={"availableNow": True}))
    valid = spark.read.parquet(out).select(
        F.lit("valid").alias("kind"), "id", F.lit(None).cast("string").alias("raw_value"), F.lit(None).cast("string").alias("reason")
    )
    quarantine = spark.read.parquet(bad).select(F.lit("quarantine").alias("kind"), F.lit(None).cast("long").alias("id"), "raw_value", "reason")
    return valid.unionByName(quarantine)


QUERIES["stream_quarantine"] = q_stream_quarantine


def q_batch_quarantine(spark, sf_dir):
    """The job documents of the batch queries and event records that carry no `_id`: every document
    leaves a row, decoded or with its raw text and the reason."""
    keyless = dt.event_history(spark, sf_dir).select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    valid, bad = decode_documents(dt.job_json(spark, sf_dir).unionByName(keyless), JOB_SCHEMA)
    none = F.lit(None)
    return valid.select(F.lit("valid").alias("kind"), F.col("_id").alias("id"), none.cast("string").alias("raw_value"), none.cast("string").alias("reason")).unionByName(
        bad.select(F.lit("quarantine").alias("kind"), none.cast("long").alias("id"), "raw_value", "reason")
    )


QUERIES["batch_quarantine"] = q_batch_quarantine


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def q_stream_restart(spark, sf_dir):
    """Jobs land in two parts. The stream stops after the first and restarts from its checkpoint
    for the second; then the first batch is replayed, as after a failure before its commit."""
    jobs = dt.job_json(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(2)))
    landing, chk = scratch_path(spark, "restart_landing"), scratch_path(spark, "restart_chk")
    out, bad = scratch_path(spark, "restart_out"), scratch_path(spark, "restart_quarantine")
    fn = decode_to_files(JOB_SCHEMA, jobs_table, out, bad)
    for part in (0, 1):
        jobs.filter(F.col("part") == part).select("value").write.text(f"{landing}/part={part}")
        src = stream_documents(spark, "text", f"{landing}/*")
        _finish(run_stream(src, fn, chk, trigger={"availableNow": True}))
    fn(spark.read.text(f"{landing}/part=0").select("value"), 0)
    return spark.read.parquet(out).drop(BATCH_COL).select(*JOBS_STREAM_COLUMNS)


QUERIES["stream_restart"] = q_stream_restart


def q_ingest_partial_pages(spark, sf_dir):
    """The second crawl's items carry the name only: the fields they do not carry stay."""
    from docflow.plans.ingest import ingest_crawl_into_store
    from docflow.sinks.keyed_store import read_keyed

    customer = dt.read_table(spark, sf_dir, "customer")
    renamed = dt.company_api_docs(customer.filter(F.col("c_acctbal") <= 0), rename_segment=True)
    crawls = (dt.api_pages(dt.company_api_docs(customer)), dt.api_pages(renamed.select("id", "display_name")))
    fields = ["display_name", "company_size", "nationalities_str"]
    root = scratch_path(spark, "company_store_partial")
    for seq, (pages, t) in enumerate(zip(crawls, CRAWL_TIMES)):
        ingest_crawl_into_store(spark, root, pages, COMPANY_API_DOC, fields, _ntz(t), seq)
    return read_keyed(spark, root, "_id").select("_id", *fields, "inserted_at", "updated_at")


QUERIES["ingest_partial_pages"] = q_ingest_partial_pages


def q_store_feed(spark, sf_dir):
    """Change events of the store's second version: companies new in the second crawl are
    inserts, those listed again are updates."""
    from docflow.plans.ingest import ingest_crawl_into_store
    from docflow.sinks.keyed_store import store_changes

    customer = dt.read_table(spark, sf_dir, "customer")
    crawls = (
        dt.api_pages(dt.company_api_docs(customer.filter(F.col("c_acctbal") > 0))),
        dt.api_pages(dt.company_api_docs(customer, rename_segment=True)),
    )
    root = scratch_path(spark, "company_store_feed")
    for seq, (pages, t) in enumerate(zip(crawls, CRAWL_TIMES)):
        ingest_crawl_into_store(spark, root, pages, COMPANY_API_DOC, ["display_name"], _ntz(t), seq)
    return store_changes(spark, root, "_id").select("operationType", "fullDocument._id", "fullDocument.display_name")


QUERIES["store_feed"] = q_store_feed
