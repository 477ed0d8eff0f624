"""Versions of the keyed store: publishing once, replays, retention with consumers, compaction, the change stream."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.operators.upsert import roll_up
from docflow.plans.ingest import pages_batch_writer, quarantine_path
from docflow.session import scratch_path
from docflow.sinks import store_log
from docflow.sinks.keyed_store import committed, read_keyed, store_changes, upsert_keyed, versions, write_version
from docflow.sinks.retention import bucket_files, compact, cursors, remove_consumer, retain
from docflow.streaming.changes import changes_writer, snapshot, store_versions
from docflow.streaming.runner import drain, run_stream

DOC = StructType([StructField("id", LongType()), StructField("name", StringType())])


def delta(spark, rows, t=1):
    return roll_up(spark.createDataFrame([(i, n, t) for i, n in rows], "_id long, name string, t long"), "_id", ["name"], ["t"], "t")


def put(spark, root, rows, t=1, **more):
    return upsert_keyed(spark, root, delta(spark, rows, t), "_id", ["name"], buckets=2, **more)


def stored(spark, root):
    return sorted((r._id, r.name) for r in read_keyed(spark, root, "_id").collect())


def test_a_second_writer_of_a_version_fails_and_is_never_seen(spark):
    root = scratch_path(spark, "t_log_race")
    put(spark, root, [(1, "a")])
    base = committed(spark, root)[-1]
    late = delta(spark, [(1, "late")], 2)
    put(spark, root, [(1, "b"), (2, "c")], 2)
    with pytest.raises(store_log.ConcurrentWrite):
        write_version(spark, root, late, "_id", base, 2)
    assert versions(spark, root) == [(1, 2), (2, 2)] and stored(spark, root) == [(1, "b"), (2, "c")]
    assert not [n for n in store_log.names(spark, f"{root}/_log") if n.endswith(".tmp")]
    left = [n for n in store_log.names(spark, root) if n.startswith("v=2_")]
    assert len(left) == 2  # the loser's data is there, but has no entry
    assert put(spark, root, [(3, "d")], 3) == 3
    retain(spark, root, keep=3)
    assert len([n for n in store_log.names(spark, root) if n.startswith("v=2_")]) == 1 and len(versions(spark, root)) == 3


def test_a_write_without_its_entry_is_invisible_and_can_be_repeated(spark, monkeypatch):
    root = scratch_path(spark, "t_log_crash")
    put(spark, root, [(1, "a")])
    with monkeypatch.context() as m:
        m.setattr(store_log, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            put(spark, root, [(1, "b")], 2)
    assert versions(spark, root) == [(1, 2)] and stored(spark, root) == [(1, "a")]
    assert put(spark, root, [(1, "b")], 2) == 2 and stored(spark, root) == [(1, "b")]


def test_transactions_of_several_streams(spark):
    root = scratch_path(spark, "t_log_txn")
    assert put(spark, root, [(1, "a")], 1, transaction=("s", 0)) == 1
    assert put(spark, root, [(1, "x")], 9, transaction=("s", 0)) == 1  # replay
    assert put(spark, root, [(2, "b")], 2, transaction=("other", 0)) == 2
    assert put(spark, root, [(3, "c")], 3) == 3
    assert put(spark, root, [(1, "x")], 9, transaction=("s", 0)) == 3
    assert put(spark, root, [(1, "d")], 4, transaction=("s", 1)) == 4
    assert stored(spark, root) == [(1, "d"), (2, "b"), (3, "c")]
    assert committed(spark, root)[-1].streams == {"s": 1, "other": 0}


def test_replayed_page_batch_leaves_no_trace(spark):
    root = scratch_path(spark, "t_log_pages")
    write = pages_batch_writer(root, DOC, ["name"], buckets=2, stream_id="a/b c")
    page = lambda n, *bodies: spark.createDataFrame([(n, b) for b in bodies], "page int, body string").withColumn("crawled_at", F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp_ntz"))
    write(page(1, '{"data":[{"id":1,"name":"a"},{"name":"keyless"}]}', "bad{"), 0)
    write(page(2, '{"data":[{"id":1,"name":"b"}]}', None), 1)
    before = sorted(map(str, spark.read.parquet(quarantine_path(root)).collect()))
    assert [x.split("reason='")[1].split("'")[0] for x in before] == ["malformed_page", "missing_or_invalid_key", "null_input"] or len(before) == 3
    for replayed in (0, 1):
        write(page(3, '{"data":[{"id":1,"name":"other"}]}', "worse{"), replayed)
    assert versions(spark, root) == [(1, 2), (2, 2)]
    assert sorted(map(str, spark.read.parquet(quarantine_path(root)).collect())) == before


def test_the_running_query_names_its_stream(spark):
    root, landing = scratch_path(spark, "t_log_query"), scratch_path(spark, "t_log_landing")
    spark.createDataFrame([(1, '{"data":[{"id":1,"name":"a"}]}')], "page int, body string").withColumn("crawled_at", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(landing)
    source = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    query = run_stream(source, pages_batch_writer(root, DOC, ["name"], buckets=2), scratch_path(spark, "t_log_chk"), trigger={"availableNow": True})
    query.awaitTermination()
    assert query.exception() is None and committed(spark, root)[-1].streams == {str(query.id): 0}


def test_retention_keeps_what_consumers_need(spark):
    root = scratch_path(spark, "t_retain")
    for k in range(1, 7):
        put(spark, root, [(k, "n"), (0, str(k))], k)
    for name, version in (("slow/one", 3), ("fast", 5)):
        store_log.write_text(spark, f"{root}/_cursors/{name.replace('/', '%2F')}.json", json.dumps({"version": version}))
    assert cursors(spark, root) == {"slow/one": 3, "fast": 5}
    assert retain(spark, root, keep=1) == [1, 2] and [v for v, _ in versions(spark, root)] == [3, 4, 5, 6]
    assert sorted(r.operationType for r in store_changes(spark, root, "_id", 4).collect()) == ["insert", "update"]
    with pytest.raises(ValueError):
        store_changes(spark, root, "_id", 3)  # its predecessor is gone: loud, not all inserts
    assert retain(spark, root, keep=1) == []
    remove_consumer(spark, root, "slow/one")
    assert retain(spark, root, keep=3) == [3] and retain(spark, root, keep=1) == [4]
    assert stored(spark, root) == [(0, "6"), *[(k, "n") for k in range(1, 7)]]
    with pytest.raises(ValueError):
        retain(spark, root, keep=0)
    assert retain(spark, scratch_path(spark, "t_retain_none")) == []


def test_compaction_changes_files_only(spark):
    root = scratch_path(spark, "t_compact")
    rows = spark.range(200).select(F.col("id").alias("_id"), F.lit("n").alias("name"), F.lit(1).cast("long").alias("inserted_at"), F.lit(1).cast("long").alias("updated_at"))
    write_version(spark, root, rows.repartition(3), "_id", None, 2)
    assert bucket_files(spark, root) == {0: 3, 1: 3}
    assert compact(spark, root, "_id") == 2 and bucket_files(spark, root) == {0: 1, 1: 1}
    assert committed(spark, root)[-1].operation == "compact"
    assert store_changes(spark, root, "_id").count() == 0 and read_keyed(spark, root, "_id").count() == 200
    assert compact(spark, root, "_id") == 2


def follow(spark, root, chk, got, **options):
    write = changes_writer(root, "_id", lambda events, batch: got.append((batch, sorted((r.version, r.operationType, r.fullDocument._id) for r in events.collect()))), consumer="c")
    drain(run_stream(store_versions(spark, root, **options), write, chk))


def test_consumer_restarts_behind_its_last_version(spark):
    root, chk, got = scratch_path(spark, "t_follow"), scratch_path(spark, "t_follow_chk"), []
    put(spark, root, [(1, "a")], 1)
    follow(spark, root, chk, got)
    for k in (2, 3, 4):
        put(spark, root, [(k, "n"), (1, str(k))], k)
    follow(spark, root, chk, got, max_versions=2)
    follow(spark, root, chk, got)
    assert [e for _, e in got] == [
        [(1, "insert", 1)],
        [(2, "insert", 2), (2, "update", 1), (3, "insert", 3), (3, "update", 1)],
        [(4, "insert", 4), (4, "update", 1)],
    ]
    assert cursors(spark, root) == {"c": 4}


def test_a_new_consumer_of_an_old_store(spark):
    root, got = scratch_path(spark, "t_snapshot"), []
    for k in (1, 2, 3):
        put(spark, root, [(k, "n")], k)
    retain(spark, root, keep=1)
    with pytest.raises(Exception, match="was removed"):
        follow(spark, root, scratch_path(spark, "t_snapshot_chk"), got)
    version, rows = snapshot(spark, root, "_id")
    assert version == 3 and sorted(r.fullDocument._id for r in rows.collect()) == [1, 2, 3]
    put(spark, root, [(4, "n")], 4)
    follow(spark, root, scratch_path(spark, "t_snapshot_chk2"), got, start_after=version)
    assert [e for _, e in got] == [[(4, "insert", 4)]]


def test_stores_of_earlier_releases_stay_readable(spark):
    root = scratch_path(spark, "t_legacy")
    put(spark, root, [(1, "a")], 1)
    [entry] = committed(spark, root)
    spark.read.parquet(f"{root}/{entry.directory}").write.bucketBy(2, "_id").sortBy("_id").option("path", f"{root}-old/v=1_b=2").saveAsTable("t_legacy_version")
    spark.sql("DROP TABLE t_legacy_version")
    assert os.path.exists(f"{root}-old/v=1_b=2/_SUCCESS".removeprefix("file:"))
    assert versions(spark, f"{root}-old") == [(1, 2)] and put(spark, f"{root}-old", [(2, "b")], 2) == 2
    assert stored(spark, f"{root}-old") == [(1, "a"), (2, "b")]
