"""Rows that used to get lost or altered without a word."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docflow.functions.columns import negotiable_label, try_int
from docflow.operators.flatten import collect_concat
from docflow.sinks.files import write_batch
from docflow.sinks.keyed_store import read_keyed, upsert_keyed
from docflow.sources.driver_tables import orders_with_items


@pytest.mark.parametrize("bucket", [1, 2, 256])
def test_concat_does_not_depend_on_the_bucket(spark, bucket):
    rows = [(1, 0, None), (1, 1, None), (1, 2, None), (1, 3, "z"), (2, 0, None), (None, 0, "lost"), (3, 0, "a"), (3, 1, "b"), (3, 2, None)]
    got = collect_concat(spark.createDataFrame(rows, "_id int, pos int, text string"), "_id", "text", bucket=bucket).collect()
    assert {r["_id"]: r["text"] for r in got} == {1: "z", 2: "", 3: "a, b"}


def test_orders_that_share_a_key_stay_apart(spark):
    orders = spark.createDataFrame([(7, 1), (7, 2), (None, 3), (None, 4)], "o_orderkey long, o_custkey long")
    orders = orders.withColumns({"o_orderstatus": F.lit("O"), "o_orderdate": F.lit(None).cast("timestamp_ntz"), "o_orderpriority": F.lit("p")})
    lines = spark.createDataFrame([(7, 1, "R", "F"), (None, 1, "N", "O")], "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string")
    got = orders_with_items(orders, lines).select("o_orderkey", "o.o_custkey", F.size("items").alias("n")).collect()
    assert {(r.o_orderkey, r.o_custkey, (r.n or 0) > 0) for r in got} == {(7, 1, True), (7, 2, True), (None, 3, False), (None, 4, False)}


def test_flags_read_as_integers(spark):
    df = spark.createDataFrame([("1",), ("1.0",), (" 1 ",), ("1.9",), ("true",), ("abc",), ("0",), (None,)], "f string")
    got = [tuple(r) for r in df.select("f", try_int("f"), negotiable_label("f", F.lit("raw"), "label")).collect()]
    assert got == [("1", 1, "label"), ("1.0", 1, "label"), (" 1 ", 1, "label"), ("1.9", 1, "label"), ("true", None, "raw"), ("abc", None, "raw"), ("0", 0, "raw"), (None, None, "raw")]


def test_an_empty_replay_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    write_batch(spark.range(3), path, 0)
    write_batch(spark.range(2), path, 1)
    write_batch(spark.range(0), path, 0)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(0, 1), (1, 1)]


def test_a_store_without_its_log_is_refused(spark, tmp_path):
    root = str(tmp_path / "store")
    delta = spark.range(3).selectExpr("id", "'v' AS doc", "timestamp_ntz'2024-01-01' AS inserted_at", "timestamp_ntz'2024-01-01' AS updated_at")
    upsert_keyed(spark, root, delta, "id", ["doc"])
    shutil.rmtree(tmp_path / "store" / "_log")
    for use in (lambda: upsert_keyed(spark, root, delta, "id", ["doc"]), lambda: read_keyed(spark, root, "id")):
        with pytest.raises(RuntimeError):
            use()


def test_a_store_without_markers_is_refused(spark, tmp_path):
    root = str(tmp_path / "store")
    delta = spark.range(3).selectExpr("id", "'v' AS doc", "timestamp_ntz'2024-01-01' AS inserted_at", "timestamp_ntz'2024-01-01' AS updated_at")
    delta.write.parquet(f"{root}/v=1_b=8")  # as earlier releases wrote a version
    for marker in tmp_path.glob("store/*/_SUCCESS"):
        marker.unlink()
    with pytest.raises(RuntimeError):
        upsert_keyed(spark, root, delta, "id", ["doc"])


def test_a_store_with_a_dollar_field_opens_in_a_fresh_catalog(spark, tmp_path):
    root = str(tmp_path / "it's a store")
    kind = StructType([StructField("$date", LongType())])
    delta = spark.range(2).select("id", F.struct(F.lit(5).cast("long")).cast(kind).alias("doc"), F.lit(None).cast("timestamp_ntz").alias("inserted_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    upsert_keyed(spark, root, delta, "id", ["doc"])
    for t in spark.catalog.listTables():
        if t.name.startswith("docflow_store_"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    assert [r.doc["$date"] for r in read_keyed(spark, root, "id").collect()] == [5, 5]
