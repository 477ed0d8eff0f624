"""Idempotent keyed append: replaying a batch adds nothing (parquet stands in for the JDBC table)."""

from docflow.session import scratch_path
from docflow.sinks.guard import guarded_delta, latest_per_key


def test_guard_replay(spark):
    path = scratch_path(spark, "t_guard")
    batch = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "id int, t int, v string")
    first = guarded_delta(spark, batch, spark.createDataFrame([], "id int"), "id", ["t"])
    assert sorted(map(tuple, first.collect())) == [(1, 2, "b"), (2, 1, "c")]
    first.write.mode("append").parquet(path)
    again = guarded_delta(spark, batch, spark.read.parquet(path), "id", ["t"])
    assert again.count() == 0
    assert spark.read.parquet(path).count() == 2


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 5, "y"), (2, 0, "z")], "id int, t int, v string")
    assert sorted(map(tuple, latest_per_key(df, "id", ["t"]).collect())) == [(1, 5, "y"), (2, 0, "z")]
