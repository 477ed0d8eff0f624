"""API page unwrap (FIXTURES.md section 4), change feed (section 5), crawl ingest."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.plans.ingest import ingest_crawls
from docflow.schemas import change_event
from docflow.sources.feed import insert_feed
from docflow.sources.pages import page_unwrap

DOC = StructType([StructField("id", LongType()), StructField("name", StringType())])


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page int, body string")


def test_unwrap(spark):
    pages = _pages(
        spark,
        [
            (1, '{"data":[{"id":1,"name":"a"},{"id":2,"name":"b"}],"meta":{"last_page":3}}'),
            (2, '{"data":[],"meta":{"last_page":3}}'),
            (3, '{"data":[{"id":2,"name":"b2"}],"meta":{"last_page":3}}'),
        ],
    )
    out = page_unwrap(pages, DOC)
    assert out.columns == ["page", "_id", "name"]
    assert sorted(map(tuple, out.collect())) == [(1, 1, "a"), (1, 2, "b"), (3, 2, "b2")]
    store = ingest_crawls([(pages, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))], DOC, ["name"])
    assert {r._id: r.name for r in store.collect()} == {1: "a", 2: "b2"}  # later page wins


def test_two_crawls_keep_first_insert(spark):
    t1 = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    t2 = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    c1 = _pages(spark, [(1, '{"data":[{"id":1,"name":"a"},{"id":2,"name":"b"}]}')])
    c2 = _pages(spark, [(1, '{"data":[{"id":2,"name":"B"},{"id":3,"name":"c"}]}')])
    s = ingest_crawls([(c1, t1), (c2, t2)], DOC, ["name"])
    got = {r._id: (r.name, r.inserted_at.day, r.updated_at.day) for r in s.collect()}
    assert got == {1: ("a", 1, 1), 2: ("B", 1, 2), 3: ("c", 2, 2)}


def test_insert_feed(spark):
    schema = change_event(DOC)
    ev = spark.createDataFrame(
        [("insert", (1, "a")), ("update", (1, "a2")), ("replace", (1, "a3")), ("delete", None), ("insert", (2, "b"))],
        schema,
    )
    assert sorted(map(tuple, insert_feed(ev).collect())) == [(1, "a"), (2, "b")]
    more = insert_feed(ev, operations=("insert", "update", "delete"))
    assert sorted(map(tuple, more.collect())) == [(1, "a"), (1, "a2"), (2, "b")]


def test_last_page_meta(spark):
    from docflow.sources.pages import last_page

    pages = _pages(spark, [(1, '{"data":[],"meta":{"last_page":3}}'), (2, '{"data":[]}')])
    assert [r.last_page for r in last_page(pages).collect()] == [3, None]
