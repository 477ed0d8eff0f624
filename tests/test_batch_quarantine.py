"""Batch input loses no document: what does not decode is a row with its text and reason."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.plans.ingest import ingest_crawls
from docflow.queries import QUERIES
from docflow.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_an_order_without_a_key_leaves_a_row(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(5)
    keyless = orders.limit(1).withColumn("o_orderkey", F.lit(None).cast(orders.schema["o_orderkey"].dataType))
    orders.unionByName(keyless).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SF}/events.parquet").limit(3).write.parquet(f"{tmp_path}/events.parquet")
    rows = QUERIES["batch_quarantine"](spark, str(tmp_path)).collect()
    assert sorted(r.kind for r in rows) == ["quarantine"] * 4 + ["valid"] * 5
    [order] = [r for r in rows if r.kind == "quarantine" and "event_id" not in r.raw_value]
    assert order.reason == "missing_or_invalid_key" and "title" in order.raw_value


def test_crawls_keep_what_they_cannot_store(spark):
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    pages = [spark.createDataFrame([(0, b)], "page int, body string") for b in ('{"data":[{"id":1,"name":"a"},{"name":"keyless"}]}', '{"data":[{"id":9,')]
    bad = scratch_path(spark, "crawl_bad")
    crawls = [(p, F.lit(f"2024-01-0{i + 1} 00:00:00").cast("timestamp_ntz")) for i, p in enumerate(pages)]
    assert [r._id for r in ingest_crawls(crawls, schema, ["name"], quarantine=bad).collect()] == [1]
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["malformed_page", "missing_or_invalid_key"]
