"""Registered queries on the keyed store and on streams with positions; with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.queries import COMPANY_API_DOC, CRAWL_TIMES, _finish, _ntz
from docflow.session import scratch_path
from docflow.sinks.files import BATCH_COL, write_batch
from docflow.sources import driver_tables as dt
from docflow.streaming.runner import drain, run_stream

THIRD_CRAWL = "2024-02-03 00:00:00"
TOPIC_CUT = 100


def _crawls(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three crawls of companies: those with a positive balance, all under another name, some under the first name again."""
    customer = dt.read_table(spark, sf_dir, "customer")
    some = customer.filter((F.col("c_acctbal") <= 0) | (F.col("c_acctbal") > 5000))
    return [
        dt.api_pages(dt.company_api_docs(customer.filter(F.col("c_acctbal") > 0))),
        dt.api_pages(dt.company_api_docs(customer, rename_segment=True)),
        dt.api_pages(dt.company_api_docs(some)),
    ]


def _ingest(spark: SparkSession, root: str, pages: DataFrame, number: int) -> None:
    from docflow.plans.ingest import ingest_crawl_into_store

    ingest_crawl_into_store(spark, root, pages, COMPANY_API_DOC, ["display_name"], _ntz([*CRAWL_TIMES, THIRD_CRAWL][number]), number)


def _events(changes: DataFrame) -> DataFrame:
    return changes.select("version", "operationType", "fullDocument._id", "fullDocument.display_name")


def q_store_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer follows the store's changes: it reads the first version and stops; two more versions are
    published; it restarts from its checkpoint and gets both, one a micro-batch."""
    from docflow.streaming.changes import changes_writer, store_versions

    root, out, chk = (scratch_path(spark, f"changes_{n}") for n in ("store", "out", "chk"))
    write = changes_writer(root, "_id", lambda events, batch_id: write_batch(_events(events), out, batch_id), consumer="follower")
    crawls = _crawls(spark, sf_dir)
    for part in ((0,), (1, 2)):
        for k in part:
            _ingest(spark, root, crawls[k], k)
        drain(run_stream(store_versions(spark, root, max_versions=1), write, chk))
    return spark.read.parquet(out).drop(BATCH_COL)


def q_store_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer has reached the second of three versions. Retention removes the first, keeps what the consumer
    needs, and the changes of the third can still be told. The versions left, and those changes."""
    from docflow.sinks.keyed_store import store_changes, versions
    from docflow.sinks.retention import retain
    from docflow.streaming.changes import changes_writer, store_versions

    root, chk = scratch_path(spark, "retention_store"), scratch_path(spark, "retention_chk")
    crawls = _crawls(spark, sf_dir)
    for k in (0, 1):
        _ingest(spark, root, crawls[k], k)
    read = changes_writer(root, "_id", lambda events, batch_id: None, consumer="slow")
    _finish(run_stream(store_versions(spark, root), read, chk, trigger={"availableNow": True}))
    _ingest(spark, root, crawls[2], 2)
    retain(spark, root, keep=1)
    events = store_changes(spark, root, "_id", 3).select(F.lit(3).cast("long").alias("version"), "operationType", "fullDocument")
    none = F.lit(None)
    kept = spark.createDataFrame([(v,) for v, _ in versions(spark, root)], "version long")
    return _events(events).unionByName(kept.select("version", F.lit("kept").alias("operationType"), none.cast("long").alias("_id"), none.cast("string").alias("display_name")))


def q_ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, and nations as pages that do not decode, arrive in two micro-batches; then the second is delivered
    again. Stored companies, quarantined pages and the store's versions."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

    from docflow.plans.ingest import pages_batch_writer, quarantine_path
    from docflow.sinks.files import JSON_TIME_OPTIONS, write_jsonl
    from docflow.sinks.keyed_store import read_keyed, versions
    from docflow.sources.stream import stream_records

    nations = dt.read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("page"), F.concat(F.lit("no page: "), "n_name").alias("body"))
    landing, root, chk = (scratch_path(spark, f"replay_{n}") for n in ("landing", "store", "chk"))
    schema = StructType([StructField("page", IntegerType()), StructField("crawled_at", TimestampNTZType()), StructField("body", StringType())])
    read = lambda path: stream_records(spark, "json", schema, path, options=JSON_TIME_OPTIONS)
    write = pages_batch_writer(root, COMPANY_API_DOC, ["display_name"], stream_id="crawler")
    crawls = _crawls(spark, sf_dir)
    for k in (0, 1):
        pages = crawls[k].unionByName(nations.filter(F.col("page") % 2 == k))
        write_jsonl(pages.withColumn("crawled_at", _ntz(CRAWL_TIMES[k])), f"{landing}/crawl={k}")
        _finish(run_stream(read(f"{landing}/*"), write, chk, trigger={"availableNow": True}))
    again = spark.read.schema(schema).options(**JSON_TIME_OPTIONS).json(f"{landing}/crawl=1")
    write(again, 1)
    stored = read_keyed(spark, root, "_id").select(F.lit("stored").alias("kind"), F.col("_id").alias("id"), F.col("display_name").alias("text"))
    bad = spark.read.parquet(quarantine_path(root)).select(F.lit("quarantine").alias("kind"), F.col("page").cast("long").alias("id"), F.col("raw_value").alias("text"))
    kept = spark.createDataFrame([("version", v, None) for v, _ in versions(spark, root)], "kind string, id long, text string")
    return stored.unionByName(bad).unionByName(kept)


def _topic_halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events as records of a topic with three partitions, in two landings: offsets below TOPIC_CUT, and the others."""
    events = dt.event_history(spark, sf_dir).filter(F.col("event_id").isNotNull())
    at = F.floor(F.col("event_id") / 3).cast("long").alias("offset")
    topic = events.select(F.pmod("event_id", F.lit(3)).cast("int").alias("partition"), at, "event_id", "user_id", "event_type")
    return [topic.filter(F.col("offset") < TOPIC_CUT), topic.filter(F.col("offset") >= TOPIC_CUT)]


def _follow_topic(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """The stream reads what has landed and stops; more lands; it restarts from its checkpoint. Every record it delivered."""
    from docflow.sources.landed_topic import land, topic_ranges, topic_writer

    path, out, chk = (scratch_path(spark, f"{name}_{n}") for n in ("topic", "out", "chk"))
    write = topic_writer(path, lambda records, batch_id: write_batch(records, out, batch_id))
    for part in _topic_halves(spark, sf_dir):
        land(part, path)
        drain(run_stream(topic_ranges(spark, path, **options), write, chk))
    return spark.read.parquet(out).select("partition", "offset", "event_id", "user_id", "event_type")


def q_topic_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the earliest offset, with a limit of a sixth of all records a micro-batch."""
    total = dt.event_history(spark, sf_dir).count()
    return _follow_topic(spark, sf_dir, "earliest", starting="earliest", max_offsets=max(100, total // 6))


def q_topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a given offset of partition 0, the latest of partition 1 and the earliest of partition 2."""
    return _follow_topic(spark, sf_dir, "offsets", starting={0: 50, 1: -1, 2: -2})


def q_first_seen_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls of companies as a stream of pages, restarted before the second and the third: each company at its first sight."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

    from docflow.sinks.files import JSON_TIME_OPTIONS, write_jsonl
    from docflow.sources.pages import page_unwrap
    from docflow.sources.stream import stream_records
    from docflow.streaming.first_seen import first_seen, keep_state_in_rocksdb

    landing, out, chk = (scratch_path(spark, f"first_seen_{n}") for n in ("landing", "out", "chk"))
    schema = StructType([StructField("page", IntegerType()), StructField("crawled_at", TimestampNTZType()), StructField("body", StringType())])
    keep_state_in_rocksdb(spark)
    for k, pages in enumerate(_crawls(spark, sf_dir)):
        write_jsonl(pages.withColumn("crawled_at", _ntz([*CRAWL_TIMES, THIRD_CRAWL][k])), f"{landing}/crawl={k}")
        source = stream_records(spark, "json", schema, f"{landing}/*", options=JSON_TIME_OPTIONS)
        items = page_unwrap(source, COMPANY_API_DOC, keep=("page", "crawled_at")).select("_id", "display_name", "crawled_at", "page")
        write = lambda df, batch_id: write_batch(df, out, batch_id)
        _finish(run_stream(first_seen(items, "_id", ["crawled_at", "page"]), write, chk, trigger={"availableNow": True}))
    return spark.read.parquet(out).select("_id", "display_name", "crawled_at")


def q_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs in two micro-batches by order status, with event records that carry no `_id` in the second, which is then replayed:
    valid, quarantined and written rows of each batch, counted in the passes that wrote them."""
    from docflow.plans.jobs import jobs_batch_table
    from docflow.schemas import JOB_SCHEMA
    from docflow.sources.stream import stream_documents
    from docflow.streaming.metrics import decode_with_metrics

    landing, out, bad, metrics, chk = (scratch_path(spark, f"metrics_{n}") for n in ("landing", "out", "bad", "kept", "chk"))
    docs = dt.job_documents(spark, sf_dir)
    keyless = dt.event_history(spark, sf_dir).select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    finished = F.coalesce(F.col("content") == "F", F.lit(False))
    parts = [dt.as_json(docs.filter(finished)), dt.as_json(docs.filter(~finished)).unionByName(keyless)]
    write = decode_with_metrics(JOB_SCHEMA, jobs_batch_table, out, bad, metrics)
    for k, part in enumerate(parts):
        part.write.text(f"{landing}/part={k}")
        _finish(run_stream(stream_documents(spark, "text", f"{landing}/*"), write, chk, trigger={"availableNow": True}))
    write(spark.read.text(f"{landing}/part=1").select("value"), 1)
    return spark.read.parquet(metrics).select(F.col(BATCH_COL).cast("long").alias(BATCH_COL), "valid", "quarantined", "written")


def q_crawl_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls whose pages arrive in two micro-batches, the second one twice. Some pages are lost, some come
    once more, and one crawl has pages behind its end. Missing, repeated and surplus pages."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from docflow.plans.completeness import crawl_gaps, page_log_writer, read_page_log
    from docflow.sinks.files import write_jsonl
    from docflow.sources.stream import stream_records

    customer = dt.read_table(spark, sf_dir, "customer")
    pages = dt.api_pages(dt.company_api_docs(customer), page_size=10)
    page = F.col("page")
    crawls = pages.filter(page % 5 != 3).withColumn("crawl", F.lit("lost"))
    crawls = crawls.unionByName(pages.filter(page % 4 == 0).withColumn("crawl", F.lit("again")))
    crawls = crawls.unionByName(pages.withColumn("crawl", F.lit("again")))
    beyond = pages.filter(page % 7 == 0).withColumns({"page": (-page - 1).cast("int"), "crawl": F.lit("beyond")})
    crawls = crawls.unionByName(pages.withColumn("crawl", F.lit("beyond"))).unionByName(beyond)
    landing, log, chk = (scratch_path(spark, f"gaps_{n}") for n in ("landing", "log", "chk"))
    schema = StructType([StructField("crawl", StringType()), StructField("page", IntegerType()), StructField("body", StringType())])
    write = page_log_writer(log)
    for k in (0, 1):
        write_jsonl(crawls.filter(F.pmod("page", F.lit(2)) == k).select("crawl", "page", "body"), f"{landing}/part={k}")
        _finish(run_stream(stream_records(spark, "json", schema, f"{landing}/*"), write, chk, trigger={"availableNow": True}))
    write(spark.read.schema(schema).json(f"{landing}/part=1"), 1)
    return crawl_gaps(read_page_log(spark, log), first=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "store_changes_stream": q_store_changes_stream,
    "store_retention": q_store_retention,
    "ingest_replay": q_ingest_replay,
    "topic_earliest": q_topic_earliest,
    "topic_offsets": q_topic_offsets,
    "first_seen_stream": q_first_seen_stream,
    "crawl_gaps": q_crawl_gaps,
    "batch_metrics": q_batch_metrics,
}

_TOPIC = """
    SELECT CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset", event_id, user_id, event_type FROM events WHERE event_id IS NOT NULL
"""

_PAGES = """
    SELECT DISTINCT CAST(floor(c_custkey / 10) AS BIGINT) AS page, CAST(floor((SELECT max(c_custkey) FROM customer) / 10) AS BIGINT) AS top FROM customer
"""

_THIRD = """
    SELECT CAST(3 AS BIGINT) AS version, 'update' AS operationType, c_custkey AS _id, c_name AS display_name
    FROM customer WHERE c_acctbal <= 0 OR c_acctbal > 5000
"""

ORACLE: dict[str, str] = {
    "store_changes_stream": f"""
        SELECT CAST(1 AS BIGINT) AS version, 'insert' AS operationType, c_custkey AS _id, c_name AS display_name FROM customer WHERE c_acctbal > 0
        UNION ALL SELECT 2, CASE WHEN c_acctbal > 0 THEN 'update' ELSE 'insert' END, c_custkey, c_mktsegment FROM customer
        UNION ALL {_THIRD}
    """,
    "store_retention": f"""
        {_THIRD} UNION ALL SELECT v, 'kept', NULL, NULL FROM (VALUES (2), (3)) t(v)
    """,
    "ingest_replay": """
        SELECT 'stored' AS kind, c_custkey AS id, c_mktsegment AS text FROM customer
        UNION ALL SELECT 'quarantine', n_nationkey, 'no page: ' || n_name FROM nation
        UNION ALL SELECT 'version', v, NULL FROM (VALUES (1), (2)) t(v)
    """,
    "topic_earliest": _TOPIC,
    "topic_offsets": f"""
        SELECT * FROM ({_TOPIC}) WHERE CASE "partition" WHEN 0 THEN "offset" >= 50 WHEN 1 THEN "offset" >= {TOPIC_CUT} ELSE true END
    """,
    "first_seen_stream": f"""
        SELECT c_custkey AS _id, CASE WHEN c_acctbal > 0 THEN c_name ELSE c_mktsegment END AS display_name,
               CASE WHEN c_acctbal > 0 THEN TIMESTAMP '{CRAWL_TIMES[0]}' ELSE TIMESTAMP '{CRAWL_TIMES[1]}' END AS crawled_at
        FROM customer
    """,
    "crawl_gaps": f"""
        WITH p AS ({_PAGES}), expected AS (SELECT unnest(range(0, (SELECT max(top) FROM p) + 1)) AS page),
        missing AS (
            SELECT 'lost' AS crawl, e.page FROM expected e WHERE e.page NOT IN (SELECT page FROM p WHERE page % 5 <> 3)
            UNION ALL SELECT c, e.page FROM expected e, (VALUES ('again'), ('beyond')) t(c) WHERE e.page NOT IN (SELECT page FROM p)
        ), numbered AS (SELECT crawl, page, page - row_number() OVER (PARTITION BY crawl ORDER BY page) AS run FROM missing)
        SELECT crawl, 'missing' AS kind, min(page) AS first_page, max(page) AS last_page, CAST(NULL AS BIGINT) AS copies FROM numbered GROUP BY crawl, run
        UNION ALL SELECT 'again', 'repeated', page, page, 2 FROM p WHERE page % 4 = 0
        UNION ALL SELECT 'beyond', 'surplus', -page - 1, -page - 1, 1 FROM p WHERE page % 7 = 0
    """,
    "batch_metrics": """
        SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS valid, CAST(0 AS BIGINT) AS quarantined,
               count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS written
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 1, count(*), (SELECT count(*) FROM events), count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
        FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL
    """,
}
