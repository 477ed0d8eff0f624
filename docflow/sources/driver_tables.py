"""Documents derived by Spark from the flat driver tables (TPC-H-like parquet).

Production input arrives nested (a document store, an API, a topic). To test and
benchmark on the driver's tables, these builders nest them with Spark:

* job      = an order; its lineitems are both `requirements_arr` (value =
             [returnflag, linestatus]) and `benefits` (value = linenumber as text),
             ordered by (linenumber, returnflag, linestatus);
* company  = a customer; API page = 100 customers by key;
* history  = `events` by user, in (ts, event_id) order.

Only the builders shuffle; the operators under test then run on their output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.columns import ts_to_epoch_millis

PAGE_SIZE = 100
DAY_MS = 86_400_000
COMPANY_EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------- jobs ---

def _null_of(df: DataFrame, col: Column) -> Column:
    return F.lit(None).cast(df.select(col).schema[0].dataType)


def orders_with_items(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Per order: its fields (struct `o`) and its lines as sorted (linenumber, returnflag,
    linestatus, n) structs in `items` (NULL when it has none).

    Identical lines are counted first; that aggregate combines map-side, so an order
    holding a large share of all lines ships one row per distinct line, not per line.
    Orders and counted lines then meet in one aggregation on the order key (a union,
    not a join: one shuffle, no sort); each group is one order plus its distinct lines.
    """
    counted = lineitem.groupBy("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )
    o = F.struct("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    i = F.struct("l_linenumber", "l_returnflag", "l_linestatus", "n")
    both = orders.select(F.col("o_orderkey").alias("k"), o.alias("o"), _null_of(counted, i).alias("i")).unionByName(
        counted.select(F.col("l_orderkey").alias("k"), _null_of(orders, o).alias("o"), i.alias("i"))
    )
    keyed = F.col("k").isNotNull()
    grouped = both.filter(keyed).groupBy("k").agg(F.collect_list("o").alias("os"), F.collect_list("i").alias("is"))
    found = grouped.filter(F.size("os") > 0).select(
        F.col("k").alias("o_orderkey"),
        F.explode("os").alias("o"),  # orders that share a key stay apart, each with the key's lines
        F.when(F.size("is") > 0, F.array_sort("is")).alias("items"),
    )
    # orders without a key have no lines: they never meet in one group, however many there are
    keyless = both.filter(~keyed & F.col("o").isNotNull()).select(F.col("k").alias("o_orderkey"), "o", F.lit(None).cast(found.schema["items"].dataType).alias("items"))
    return found.unionByName(keyless)


def _expand(items: Column, make) -> Column:
    return F.flatten(F.transform(items, lambda x: F.array_repeat(make(x), x["n"].cast("int"))))


def job_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested job documents (struct columns laid out like the job JSON)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    joined = orders_with_items(orders, lines).select("o_orderkey", "o.*", "items")
    millis = ts_to_epoch_millis("o_orderdate")
    req = _expand(
        F.col("items"),
        lambda x: F.struct(F.array(x["l_returnflag"], x["l_linestatus"]).alias("value")),
    )
    ben = _expand(
        F.col("items"),
        lambda x: F.struct(x["l_linenumber"].alias("id"), x["l_linenumber"].cast("string").alias("value")),
    )
    return joined.select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("content"),
        F.concat(F.lit("/jobs/"), F.col("o_orderkey").cast("string")).alias("detail_url"),
        F.struct(millis.alias("$date")).alias("inserted_at"),
        F.struct((millis + F.lit(DAY_MS)).alias("$date")).alias("updated_at"),
        F.col("o_custkey").alias("owned_id"),
        F.col("o_orderpriority").alias("skills_str"),
        req.alias("requirements_arr"),
        F.struct(
            F.when(F.col("o_orderstatus") == "O", F.lit("1")).otherwise(F.lit("0")).alias("is_negotiable"),
            F.col("o_orderstatus").alias("value"),
        ).alias("salary"),
        ben.alias("benefits"),
    )


def as_json(docs: DataFrame) -> DataFrame:
    """Documents -> one JSON text column `value` (the wire form)."""
    return docs.select(F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("value"))


def job_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_json(job_documents(spark, sf_dir))


# ---------------------------------------------------------------- companies ---

def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company documents; customers with a non-positive balance have no address."""
    c = read_table(spark, sf_dir, "customer")
    first_seen = F.timestamp_add("SECOND", F.col("c_custkey"), F.expr(COMPANY_EPOCH))
    return c.select(
        F.col("c_custkey").alias("_id"),
        F.concat(F.lit("logo/"), F.col("c_custkey").cast("string")).alias("image_logo"),
        F.col("c_name").alias("display_name"),
        F.col("c_mktsegment").alias("company_size"),
        F.col("c_nationkey").cast("string").alias("num_employees"),
        F.col("c_mktsegment").alias("industries_str"),
        F.col("c_nationkey").cast("string").alias("nationalities_str"),
        F.struct(
            F.when(F.col("c_acctbal") > 0, F.array("c_name", "c_mktsegment"))
            .otherwise(F.array().cast("array<string>"))
            .alias("full_addresses")
        ).alias("addresses"),
        F.concat(F.lit("/companies/"), F.col("c_custkey").cast("string")).alias("detail_url"),
        first_seen.alias("inserted_at"),
        F.timestamp_add("DAY", F.lit(1), first_seen).alias("updated_at"),
    )


def company_api_docs(customer: DataFrame, rename_segment: bool = False) -> DataFrame:
    """Company documents as the API returns them (key `id`)."""
    name = F.col("c_mktsegment") if rename_segment else F.col("c_name")
    return customer.select(
        F.col("c_custkey").alias("id"),
        name.alias("display_name"),
        F.col("c_mktsegment").alias("company_size"),
        F.col("c_nationkey").cast("string").alias("nationalities_str"),
    )


def api_pages(docs: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Group API documents into pages of `page_size` keys: (page, body JSON).

    A page holds at most `page_size` documents (keys are unique), so the grouping
    is bounded by construction. `meta.last_page` is a scalar subquery.
    """
    paged = docs.withColumn("page", F.floor(F.col("id") / F.lit(page_size)).cast("int"))
    last = paged.select(F.max("page")).scalar()
    grouped = paged.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct(*[c for c in docs.columns]))).alias("data")
    )
    return grouped.select(
        "page",
        F.to_json(F.struct(F.col("data"), F.struct(last.alias("last_page")).alias("meta"))).alias("body"),
    )


# ------------------------------------------------------------------ events ---

def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change stream of the user documents: a user's first event is its insert, later ones updates.

    The first event per user is an aggregate (map-side combined); tagging joins on the
    full (user_id, ts, event_id) key, so a hot user's rows spread over all partitions.
    """
    ev = event_history(spark, sf_dir)
    firsts = ev.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("f")).select(
        F.col("user_id").alias("f_user"), F.col("f.ts").alias("f_ts"), F.col("f.event_id").alias("f_event"), F.lit(True).alias("is_first")
    )
    pairs = (("user_id", "f_user"), ("ts", "f_ts"), ("event_id", "f_event"))
    tagged = ev.join(firsts, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs], "left")  # a first event may lack its time or user
    return tagged.select(
        F.when(F.col("is_first"), F.lit("insert")).otherwise(F.lit("update")).alias("operationType"),
        F.struct(
            F.col("user_id").alias("_id"),
            "event_id",
            "ts",
            "event_type",
            "props",
        ).alias("fullDocument"),
    )


def field_updates(spark: SparkSession, sf_dir: str, null_below: float = 2.0) -> DataFrame:
    """Partial documents: each event sets one field (its type) to its id, or to an
    explicit JSON null when `value` < `null_below`. Columns: user_id, ts, event_id, doc."""
    ev = event_history(spark, sf_dir)
    v = F.when(F.col("value") < F.lit(null_below), F.lit(None).cast("string")).otherwise(
        F.col("event_id").cast("string")
    )
    return ev.select("user_id", "ts", "event_id", F.to_json(F.create_map(F.col("event_type"), v)).alias("doc"))
