"""Keyed state over restarts, and counts of micro-batches."""

import datetime as dt

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.session import scratch_path
from docflow.sinks.files import write_batch
from docflow.streaming.first_seen import ROCKSDB, STATE_PROVIDER, first_seen, keep_state_in_rocksdb
from docflow.streaming.metrics import BatchProgress, counted, decode_with_metrics
from docflow.streaming.runner import run_stream

ITEMS = "_id long, name string, at timestamp_ntz, page int"
DOC = StructType([StructField("_id", LongType()), StructField("name", StringType())])


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(STATE_PROVIDER, None)
    keep_state_in_rocksdb(spark)
    assert spark.conf.get(STATE_PROVIDER) == ROCKSDB
    yield
    spark.conf.unset(STATE_PROVIDER) if before is None else spark.conf.set(STATE_PROVIDER, before)


def test_first_sight_over_restarts(spark, rocksdb):
    landing, out, chk = (scratch_path(spark, f"t_seen_{n}") for n in ("landing", "out", "chk"))
    batches = [
        [(1, "b", day(2), 1), (1, "a", day(1), 9), (1, "c", day(1), 10), (2, "x", None, 1), (None, "keyless", day(1), 1)],
        [(1, "later", day(3), 1), (3, "n", day(3), 2), (2, "y", day(3), 1)],
        [(3, "again", day(4), 1), *[(4, f"hot{k}", day(5), 500 - k) for k in range(500)]],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, ITEMS).repartition(2).write.parquet(f"{landing}/part={k}")
        source = spark.readStream.schema(ITEMS).parquet(f"{landing}/*")
        query = run_stream(first_seen(source, "_id", ["at", "page"]), lambda df, b: write_batch(df, out, b), chk, trigger={"availableNow": True})
        query.awaitTermination()
        assert query.exception() is None
    got = sorted((r.batch_id, r._id, r.name) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1, "a"), (0, 2, "x"), (1, 3, "n"), (2, 4, "hot499")]


def test_first_sight_of_many_keys_keeps_long_keys_apart(spark, rocksdb):
    """Rows of a key are in several files; keys above 2**53 stand beside rows without a key."""
    landing, out, chk = (scratch_path(spark, f"t_many_{n}") for n in ("landing", "out", "chk"))
    keys = [2**60 + k for k in range(3000)]
    seen = [(k, f"{k}/{p}", day(p), p) for k in keys for p in (3, 2, 4)]
    source = spark.readStream.schema(ITEMS).parquet(f"{landing}/*")
    items = first_seen(source, "_id", ["at", "page"])
    batches = [seen + [(None, "keyless", day(1), 1)] * 50, [(k + 1000, f"{k + 1000}/1", day(1), 1) for k in keys]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, ITEMS).repartition(6).write.parquet(f"{landing}/part={n}")
        query = run_stream(items, lambda df, b: write_batch(df, out, b), chk, trigger={"availableNow": True})
        query.awaitTermination()
        assert query.exception() is None
    got = sorted((r.batch_id, r._id, r.name) for r in spark.read.parquet(out).collect())
    assert got == [(0, k, f"{k}/2") for k in keys] + [(1, k, f"{k}/1") for k in range(2**60 + 3000, 2**60 + 4000)]


def test_first_sight_asks_no_python_for_the_state_of_a_key(spark, tmp_path):
    spark.createDataFrame([], ITEMS).write.parquet(f"{tmp_path}/landing")
    source = spark.readStream.schema(ITEMS).parquet(f"{tmp_path}/landing")
    plan = first_seen(source, "_id", ["at", "page"])._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate [_id" in plan and "TransformWithState" not in plan


def lines(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(path)


def test_counts_of_each_batch_and_of_a_replay(spark):
    landing, out, bad, kept, chk = (scratch_path(spark, f"t_metrics_{n}") for n in ("landing", "out", "bad", "kept", "chk"))
    write = decode_with_metrics(DOC, lambda d: d.filter("name is not null"), out, bad, kept)
    listener = BatchProgress()
    spark.streams.addListener(listener)
    try:
        for k, rows in enumerate([['{"_id":1,"name":"a"}', '{"_id":2}', "bad{"], ['{"name":"x"}', '{"_id":3,"name":"c"}'], ["worse{"]]):
            lines(spark, f"{landing}/part={k}", rows)
            source = spark.readStream.text(f"{landing}/*").select("value")
            query = run_stream(source, write, chk, trigger={"availableNow": True})
            query.awaitTermination()
            assert query.exception() is None
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    counts = lambda: sorted((r.batch_id, r.valid, r.quarantined, r.written) for r in spark.read.parquet(kept).collect())
    assert counts() == [(0, 2, 1, 1), (1, 1, 1, 1), (2, 0, 1, 0)]
    assert {b: m["input"] for (q, b), m in listener.batches.items() if q == str(query.id)} == {0: 3, 1: 2, 2: 1}
    write(spark.read.text(f"{landing}/part=1").select("value"), 1)
    assert counts() == [(0, 2, 1, 1), (1, 1, 1, 1), (2, 0, 1, 0)]
    assert spark.read.parquet(out).count() == 2 and spark.read.parquet(bad).count() == 3


def test_a_count_runs_no_job_of_its_own(spark):
    spark.sparkContext.setJobGroup("t_counted", "write")
    try:
        df, seen = counted(spark.range(100).filter("id % 3 = 0"), "t_counted")
        df.write.format("noop").mode("overwrite").save()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("t_counted"))
        assert seen.get["count"] == 34 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("t_counted")) == jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
