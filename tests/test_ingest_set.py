"""Ingest keeps what a crawl does not carry, stores undeclared fields, and loses no page or item."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from docflow.operators.decode import as_text
from docflow.operators.upsert import merge, roll_up, split_keyless
from docflow.plans.ingest import ingest_crawl_into_store, ingest_crawls, quarantine_path
from docflow.session import scratch_path
from docflow.sinks.keyed_store import read_keyed, store_changes
from docflow.sources.feed import events_without_document, insert_feed
from docflow.sources.pages import page_items
from docflow.streaming.runner import decode_to_jdbc

DOC = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("size", StringType()),
        StructField("score", DoubleType()),
        StructField("at", StructType([StructField("$date", LongType())])),
    ]
)
FIELDS = ["name", "size", "score", "at"]


def _t(day):
    return F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz")


def _pages(spark, *bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page int, body string")


def test_absent_fields_stay_and_open_fields_are_stored(spark):
    c1 = _pages(spark, '{"data":[{"id":1,"name":"a","size":"big","score":1.5,"at":{"$date":7},"extra":{"x":[1]}}]}')
    c2 = _pages(spark, '{"data":[{"id":1,"name":"a2","size":null}]}', '{"data":[{"id":1,"score":2}]}')
    [r] = ingest_crawls([(c1, _t(1)), (c2, _t(2))], DOC, FIELDS).collect()
    assert (r.name, r.size, r.score, r.at["$date"]) == ("a2", None, 2.0, 7)
    assert r.doc["extra"] == '{"x":[1]}' and "size" in r.doc and r.doc["size"] is None
    assert (r.inserted_at.day, r.updated_at.day) == (1, 2)


def test_store_keeps_fields_gives_changes_and_quarantines(spark):
    root = scratch_path(spark, "set_store")
    ok = '{"data":[{"id":1,"name":"a","at":{"$date":7}},{"name":"keyless"},{"id":"x"}]}'
    ingest_crawl_into_store(spark, root, _pages(spark, ok, '{"data":[{"id":9,', None, "{}"), DOC, FIELDS, _t(1), buckets=2)
    assert {r.operationType for r in store_changes(spark, root, "_id").collect()} == {"insert"}
    ingest_crawl_into_store(spark, root, _pages(spark, '{"data":[{"id":1,"size":"s"},{"id":2,"name":"b"}]}'), DOC, FIELDS, _t(2))
    rows = {r._id: r for r in read_keyed(spark, root, "_id").collect()}
    assert set(rows) == {1, 2} and (rows[1].name, rows[1].size, rows[1].at["$date"]) == ("a", "s", 7)
    assert sorted((r.operationType, r.fullDocument._id) for r in store_changes(spark, root, "_id").collect()) == [("insert", 2), ("update", 1)]
    assert [r._id for r in insert_feed(store_changes(spark, root, "_id")).collect()] == [2]
    bad = spark.read.parquet(quarantine_path(root)).collect()
    assert sorted(r.reason for r in bad) == ["malformed_page", "missing_or_invalid_key", "missing_or_invalid_key", "no_data", "null_input"]


def test_truncated_page_keeps_its_text(spark):
    items, bad = page_items(_pages(spark, '{"data":[{"id":1}]}', '{"data":[{"id":2},{"id":3', '{"data":[]}'), DOC)
    assert [r._id for r in items.collect()] == [1]
    assert [(r.page, r.reason) for r in bad.collect()] == [(1, "malformed_page")]


def test_null_keys_fail_loudly_instead_of_multiplying(spark):
    df = spark.createDataFrame([(1, "a", 1), (None, "b", 2)], "k int, v string, t int")
    keyed, keyless = split_keyless(df, "k")
    assert keyed.count() == 1 and keyless.count() == 1
    rolled = roll_up(df, "k", ["v"], ["t"], "t")
    with pytest.raises(Exception, match="NULL k in an upsert"):
        merge(rolled, rolled, "k", ["v"]).collect()
    good = roll_up(keyed, "k", ["v"], ["t"], "t")
    assert merge(good, good, "k", ["v"]).count() == 1


def test_updates_without_document_are_returned(spark):
    ev = spark.createDataFrame([("insert", (1,)), ("update", None), ("delete", None)], "operationType string, fullDocument struct<_id:int>")
    ops = ("insert", "update")
    assert insert_feed(ev, ops).count() == 1
    assert [r.operationType for r in events_without_document(ev, ops).collect()] == ["update"]


def test_decode_hands_valid_rows_to_a_table_writer(spark):
    got, bad = [], scratch_path(spark, "jdbc_quarantine")
    schema = StructType([StructField("_id", LongType()), StructField("name", StringType())])
    fn = decode_to_jdbc(schema, lambda d: d.select("_id"), lambda d, b: got.append((b, [r._id for r in d.collect()])), bad)
    batch = spark.createDataFrame([(b'{"_id":1,"name":"a"}',), (b"not json",), (None,)], "value binary")
    assert as_text(batch).columns == ["value"]
    fn(batch, 4)
    assert got == [(4, [1])]
    assert spark.read.parquet(bad).count() == 2
