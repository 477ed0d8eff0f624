"""One key holding a third of all rows: results stay whole and exact, work stays split."""

from pyspark.sql import functions as F

from docflow.operators.flatten import collect_concat
from docflow.operators.upsert import roll_up_open
from docflow.sources.driver_tables import orders_with_items


def test_collect_concat_hot_key(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") / 3).cast("int").alias("pos"),
        F.col("id").cast("string").alias("text"),
    ).repartition(8)
    out = collect_concat(df, "k", "text", bucket=256)
    hot = out.filter("k = 0").first().text.split(", ")
    assert len(hot) == n // 3
    assert hot == [str(i * 3) for i in range(n // 3)]
    assert out.count() == 1 + (n - n // 3)
    # the level that sees a whole key gets ceil(n / bucket) partial strings, not n rows
    partial = df.filter("k = 0").groupBy("k", F.floor(F.col("pos") / 256)).count()
    assert partial.count() == -(-(n // 3) // 256)


def test_document_build_hot_order(spark):
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("l_orderkey"),
        (F.col("id") % 2 + 1).cast("int").alias("l_linenumber"),
        F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
    )
    orders = spark.createDataFrame(
        [(7, 1, "O", None, "1-URGENT"), (8, 2, "F", None, "2-HIGH")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    )
    got = {r.o_orderkey: r["items"] for r in orders_with_items(orders, lines).collect()}
    assert set(got) == {7, 8} and got[8] is None
    assert [(i.l_linenumber, i.n) for i in got[7]] == [(1, 1500), (2, 1500)]


def test_open_rollup_hot_key(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
        F.create_map(F.concat(F.lit("f"), (F.col("id") % 4).cast("string")), F.col("id").cast("string")).alias("m"),
    )
    r = roll_up_open(df, "k", "m", ["t"], "t").filter("k = 1").first()
    assert dict(r.doc) == {"f0": "5988", "f1": "5997", "f2": "5994", "f3": "5991"}
    assert (r.inserted_at, r.updated_at) == (0, 5997)
