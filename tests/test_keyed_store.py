"""Bucketed keyed store: incremental upserts equal the full roll-up; the stored side is not shuffled."""

from pyspark.sql import functions as F

from docflow.operators.upsert import merge, roll_up, roll_up_fields
from docflow.session import scratch_path
from docflow.sinks.keyed_store import read_keyed, upsert_keyed

SF = "/root/testdata/sf0.001"
FIELDS = ["event_type", "value", "props"]


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def test_store_equals_full_rollup(spark):
    ev = _events(spark)
    root = scratch_path(spark, "t_keyed")
    cuts = ["2024-01-08", "2024-01-16", "2024-01-24"]
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = ev
        if lo:
            part = part.filter(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            part = part.filter(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        upsert_keyed(spark, root, roll_up(part, "user_id", FIELDS, ["ts", "event_id"], "ts"), "user_id", FIELDS, buckets=8)
    got = read_keyed(spark, root, "user_id")
    full = roll_up(ev, "user_id", FIELDS, ["ts", "event_id"], "ts")
    cols = ["user_id", *FIELDS, "inserted_at", "updated_at"]
    assert got.select(cols).exceptAll(full.select(cols)).count() == 0
    assert full.select(cols).exceptAll(got.select(cols)).count() == 0


def test_merge_does_not_shuffle_stored_side(spark):
    ev = _events(spark)
    root = scratch_path(spark, "t_keyed_plan")
    upsert_keyed(spark, root, roll_up(ev, "user_id", FIELDS, ["ts", "event_id"], "ts"), "user_id", FIELDS, buckets=8)
    stored = read_keyed(spark, root, "user_id")
    delta = roll_up(ev.filter("event_type = 'click'"), "user_id", FIELDS, ["ts", "event_id"], "ts")
    plan = merge(stored, delta, "user_id", FIELDS)._jdf.queryExecution().executedPlan().toString()
    scan_line = [ln for ln in plan.splitlines() if "docflow_store_" in ln][0]
    assert "Bucketed: true" in scan_line
    # the stored scan feeds the join through a Sort only: no Exchange above it
    lines = plan.splitlines()
    i = lines.index(scan_line)
    assert "Exchange" not in lines[i - 1] and "Exchange" not in lines[i - 2]


def test_field_presence_store(spark):
    rows1 = [(1, 1, '{"a":"x","b":"y"}'), (2, 1, '{"a":"q"}')]
    rows2 = [(1, 2, '{"a":null}'), (1, 3, '{"c":"z"}')]
    root = scratch_path(spark, "t_keyed_fields")
    for rows in (rows1, rows2):
        df = spark.createDataFrame(rows, "_id int, t int, doc string").withColumn(
            "m", F.from_json("doc", "map<string,string>")
        )
        upsert_keyed(spark, root, roll_up_fields(df, "_id", "m", ["a", "b", "c"], ["t"], "t"), "_id",
                     ["a", "b", "c"], buckets=4, presence=True)
    got = {r._id: (r.a, r.b, r.c, r.inserted_at, r.updated_at) for r in read_keyed(spark, root, "_id").collect()}
    assert got == {1: (None, "y", "z", 1, 3), 2: ("q", None, None, 1, 1)}


def test_bucket_count_travels_with_store(spark):
    from docflow.sinks.keyed_store import versions

    ev = _events(spark)
    root = scratch_path(spark, "t_keyed_buckets")
    r = roll_up(ev, "user_id", FIELDS, ["ts", "event_id"], "ts")
    upsert_keyed(spark, root, r, "user_id", FIELDS, buckets=8)
    upsert_keyed(spark, root, r, "user_id", FIELDS)  # keeps 8
    upsert_keyed(spark, root, r, "user_id", FIELDS, buckets=4)  # re-buckets
    assert versions(spark, root) == [(1, 8), (2, 8), (3, 4)]
    assert read_keyed(spark, root, "user_id").count() == r.count()


def test_pages_writer_replay_is_harmless(spark):
    import datetime as dt

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from docflow.plans.ingest import pages_batch_writer

    doc = StructType([StructField("id", LongType()), StructField("name", StringType())])
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    b0 = spark.createDataFrame(
        [(1, t1, '{"data":[{"id":1,"name":"a"},{"id":2,"name":"b"}]}')], "page int, crawled_at timestamp_ntz, body string"
    )
    b1 = spark.createDataFrame([(1, t2, '{"data":[{"id":2,"name":"B"}]}')], "page int, crawled_at timestamp_ntz, body string")
    root = scratch_path(spark, "t_pages_store")
    fn = pages_batch_writer(root, doc, ["name"], buckets=4)
    fn(b0, 0)
    fn(b1, 1)
    once = sorted(map(tuple, read_keyed(spark, root, "_id").collect()))
    fn(b1, 1)  # replay of the last batch
    assert sorted(map(tuple, read_keyed(spark, root, "_id").collect())) == once
    assert [(r[0], r[1], r[2].day, r[3].day) for r in once] == [(1, "a", 1, 1), (2, "B", 1, 2)]
