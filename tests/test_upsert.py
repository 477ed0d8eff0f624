"""Keyed upsert (FIXTURES.md section 6) and incremental == full roll-up."""

import random

from pyspark.sql import functions as F

from docflow.operators.upsert import apply_batches, merge, roll_up, roll_up_fields


def _hist(spark):
    rows = [(1, 1, '{"a":"x","b":"y"}'), (1, 2, '{"a":null}'), (1, 3, '{"c":"z"}'), (2, 1, '{"a":"q"}')]
    return spark.createDataFrame(rows, "_id int, t int, doc string").withColumn(
        "m", F.from_json("doc", "map<string,string>")
    )


def test_field_presence(spark):
    out = roll_up_fields(_hist(spark), "_id", "m", ["a", "b", "c"], ["t"], "t")
    got = {r._id: (r.a, r.b, r.c, r.inserted_at, r.updated_at) for r in out.collect()}
    assert got == {1: (None, "y", "z", 1, 3), 2: ("q", None, None, 1, 1)}


def test_incremental_fields_equal_full(spark):
    rnd = random.Random(7)
    rows = []
    for t in range(4000):
        k = rnd.randrange(97)
        doc = {f: (None if rnd.random() < 0.2 else f"{f}{t}") for f in "abcd" if rnd.random() < 0.4}
        import json

        rows.append((k, t, json.dumps(doc)))
    df = spark.createDataFrame(rows, "_id int, t int, doc string").withColumn(
        "m", F.from_json("doc", "map<string,string>")
    )
    fields = list("abcd")
    full = roll_up_fields(df, "_id", "m", fields, ["t"], "t")
    cuts = [df.filter(F.col("t") < 1000), df.filter((F.col("t") >= 1000) & (F.col("t") < 2500)), df.filter(F.col("t") >= 2500)]
    inc = apply_batches(cuts, "_id", "m", fields, ["t"], "t")
    cols = ["_id", *fields, "inserted_at", "updated_at"]
    assert full.select(cols).exceptAll(inc.select(cols)).count() == 0
    assert inc.select(cols).exceptAll(full.select(cols)).count() == 0


def test_whole_document_merge(spark):
    rows = [(1, 1, "a1"), (1, 5, "a5"), (2, 2, "b2"), (3, 9, "c9"), (1, 7, "a7")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    full = roll_up(df, "k", ["v"], ["t"], "t")
    a = roll_up(df.filter("t < 5"), "k", ["v"], ["t"], "t")
    b = roll_up(df.filter("t >= 5"), "k", ["v"], ["t"], "t")
    inc = merge(a, b, "k", ["v"])
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, inc.select(full.columns).collect()))
    assert {r.k: (r.v, r.inserted_at, r.updated_at) for r in inc.collect()} == {
        1: ("a7", 1, 7), 2: ("b2", 2, 2), 3: ("c9", 9, 9)
    }


def test_hot_key_aggregates_map_side(spark):
    """One key with a third of the rows: plan is partial + final aggregate (no raw-row gather)."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = roll_up(df, "k", ["t"], ["t"], "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "partial_max" in plan
    assert out.filter("k = 0").first().updated_at == 29997


def test_open_fields_match_declared(spark):
    from docflow.operators.upsert import merge_open, roll_up_open

    h = _hist(spark)
    full = roll_up_open(h, "_id", "m", ["t"], "t")
    got = {r._id: (dict(r.doc), r.inserted_at, r.updated_at) for r in full.collect()}
    assert got == {1: ({"a": None, "b": "y", "c": "z"}, 1, 3), 2: ({"a": "q"}, 1, 1)}
    inc = merge_open(roll_up_open(h.filter("t < 2"), "_id", "m", ["t"], "t"),
                     roll_up_open(h.filter("t >= 2"), "_id", "m", ["t"], "t"), "_id")
    assert {r._id: (dict(r.doc), r.inserted_at, r.updated_at) for r in inc.collect()} == got


def test_fold_checkpoints_long_histories(spark):
    """Ten batches with a checkpoint every 3 merges equal the one-shot roll-up."""
    rows = [(k % 7, t, f"v{t}") for t, k in enumerate(range(200))]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    from docflow.operators.upsert import fold_batches

    batches = [df.filter((F.col("t") >= i * 20) & (F.col("t") < (i + 1) * 20)) for i in range(10)]
    inc = fold_batches(batches, lambda b: roll_up(b, "k", ["v"], ["t"], "t"), lambda a, b: merge(a, b, "k", ["v"]), 3)
    full = roll_up(df, "k", ["v"], ["t"], "t")
    assert sorted(map(tuple, inc.select(full.columns).collect())) == sorted(map(tuple, full.collect()))
