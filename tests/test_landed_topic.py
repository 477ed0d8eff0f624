"""Streams with positions by partition and offset: start, limit, restart, lost records."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from docflow.session import scratch_path
from docflow.sources.landed_topic import land, records, topic_ranges, topic_writer
from docflow.streaming.runner import drain, run_stream


def put(spark, path, *runs):
    """runs: (partition, from, until)."""
    rows = [(p, o, f"{p}:{o}") for p, low, high in runs for o in range(low, high)]
    land(spark.createDataFrame(rows, "partition int, offset long, value string").repartition(3), path)


def follow(spark, path, chk, got, **options):
    def take(df, batch_id):
        got.append(sorted((r.partition, r.offset) for r in df.collect()))

    drain(run_stream(topic_ranges(spark, path, **options), topic_writer(path, take), chk))


def offsets(*runs):
    return sorted((p, o) for p, low, high in runs for o in range(low, high))


@pytest.fixture
def topic(spark):
    return scratch_path(spark, "t_topic"), scratch_path(spark, "t_topic_chk"), []


def test_earliest_with_restart_and_a_new_partition(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 5, 20), (1, 0, 3))
    follow(spark, path, chk, got)
    follow(spark, path, chk, got)  # nothing new: no batch
    put(spark, path, (0, 20, 25), (2, 7, 9))
    follow(spark, path, chk, got, starting="latest")  # the checkpoint decides, not the option
    assert got == [offsets((0, 5, 20), (1, 0, 3)), offsets((0, 20, 25), (2, 7, 9))]


def test_latest_takes_only_what_lands_later(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 0, 10), (1, 0, 4))
    follow(spark, path, chk, got, starting="latest")
    put(spark, path, (0, 10, 12), (1, 4, 5))
    follow(spark, path, chk, got, starting="latest")
    assert got == [offsets((0, 10, 12), (1, 4, 5))]


def test_given_offsets(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 0, 10), (1, 0, 10), (2, 0, 10), (3, 2, 4))
    follow(spark, path, chk, got, starting={0: 7, 1: -1, 2: -2})
    put(spark, path, (1, 10, 11))
    follow(spark, path, chk, got, starting={0: 0})
    assert got == [offsets((0, 7, 10), (2, 0, 10), (3, 2, 4)), offsets((1, 10, 11))]
    with pytest.raises(ValueError):
        topic_ranges(spark, path, starting="middle")


def test_limit_is_shared_and_loses_nothing(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 0, 90), (1, 0, 9), (2, 0, 1))
    follow(spark, path, chk, got, max_offsets=20)
    put(spark, path, (1, 9, 30))
    follow(spark, path, chk, got, max_offsets=20)
    assert sorted(x for batch in got for x in batch) == offsets((0, 0, 90), (1, 0, 30), (2, 0, 1))
    assert len(got) > 5 and all(len(batch) <= 20 + 3 for batch in got)
    assert {p for p, _ in got[0]} == {0, 1, 2}  # every partition moves on


def test_a_batch_that_failed_is_repeated_with_the_same_range(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 0, 5))

    def fail(df, batch_id):
        got.append(sorted((r.partition, r.offset) for r in df.collect()))
        raise OSError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        drain(run_stream(topic_ranges(spark, path), topic_writer(path, fail), chk))
    put(spark, path, (0, 5, 8))
    follow(spark, path, chk, got)
    assert got == [offsets((0, 0, 5)), offsets((0, 0, 5)), offsets((0, 5, 8))]


def test_records_gone_before_they_were_read_are_an_error(spark, topic):
    path, chk, got = topic
    put(spark, path, (0, 0, 5))
    follow(spark, path, chk, got)
    old = set(glob.glob(f"{path}/partition=0/*"))
    put(spark, path, (0, 5, 8))
    middle = set(glob.glob(f"{path}/partition=0/*")) - old
    put(spark, path, (0, 8, 9))
    for f in middle:
        os.remove(f)
    for f in old:
        os.remove(f)
    with pytest.raises(Exception, match="offsets 5 to 7 are gone"):
        follow(spark, path, chk, got)


def test_ranges_prune_partitions_and_push_offsets(spark, topic):
    path, _, _ = topic
    put(spark, path, (0, 0, 5), (1, 0, 5), (2, 0, 5))
    df = records(spark, path, [(0, 1, 3), (2, 0, 1)])
    assert sorted((r.partition, r.offset) for r in df.collect()) == offsets((0, 1, 3), (2, 0, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((partition" in plan and "GreaterThanOrEqual(offset" in plan
    assert records(spark, path, []).count() == 0
    assert df.filter(F.col("value").isNull()).count() == 0
