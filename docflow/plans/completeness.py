"""Is a crawl complete? Missing, repeated and surplus pages against the `last_page` that the pages name.

A crawl is known by its log: one small row for each page that arrived (crawl, page, last_page), written by micro-batch
next to the items. Batches replace their own folder, so a replay adds nothing, and a crawl may span any number of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.sinks.files import BATCH_COL, write_batch

GAPS = "crawl, kind, first_page, last_page, copies"


def page_log(pages: DataFrame, crawl_col: str = "crawl", body_col: str = "body") -> DataFrame:
    """(crawl, page, last_page) of landed pages; `last_page` is NULL where the body does not name it."""
    named = F.get_json_object(F.col(body_col), "$.meta.last_page").try_cast("long")
    return pages.select(F.col(crawl_col).alias("crawl"), F.col("page").cast("long").alias("page"), named.alias("last_page"))


def page_log_writer(path: str, crawl_col: str = "crawl") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the log of a micro-batch as `path/batch_id=N`."""

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(page_log(batch_df, crawl_col), path, batch_id)

    return fn


def read_page_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH_COL)


def crawl_gaps(log: DataFrame, first: int = 1) -> DataFrame:
    """What is wrong with each crawl of a log: (crawl, kind, first_page, last_page, copies).

    - `missing`: a range of pages between `first` and the crawl's last page of which none arrived;
    - `repeated`: a page that arrived `copies` times;
    - `surplus`: a page before `first` or behind the last page;
    - `no_end`: a crawl none of whose pages names a last page (its first and last page that arrived);
    - `no_number`: `copies` pages without a page number.

    A crawl's last page is the largest one that any of its pages names. A complete crawl has no row.

    Pages are counted by (crawl, page), and a page that ends a run of pages is found by an equality join with its
    successor, so a crawl that holds most of all pages is spread over all tasks. Only the ends of runs are
    ordered within a crawl: a row for each gap, not for each page.
    """
    counted = log.groupBy("crawl", "page").agg(F.count("*").alias("copies"), F.max("last_page").alias("named"))
    ends = counted.groupBy("crawl").agg(F.max("named").alias("end"), F.min("page").alias("low"), F.max("page").alias("high"))
    pages = counted.filter(F.col("page").isNotNull()).join(ends.withColumnRenamed("crawl", "of"), F.col("crawl").eqNullSafe(F.col("of"))).drop("of")
    none = F.lit(None).cast("long")

    def rows(df: DataFrame, kind: str, low, high, copies) -> DataFrame:
        return df.select("crawl", F.lit(kind).alias("kind"), low.cast("long").alias("first_page"), high.cast("long").alias("last_page"), copies.cast("long").alias("copies"))

    page = F.col("page")
    inside = pages.filter((page >= first) & (page <= F.col("end")))
    # runs of pages that arrived: a last page has no successor, a first page no predecessor; walls stand on both sides of the crawl
    walls = ends.filter(F.col("end") >= first).select("crawl", F.explode(F.array(F.lit(first - 1).cast("long"), F.col("end") + 1)).alias("page"))
    standing = inside.select("crawl", "page").unionByName(walls)
    neighbour = standing.select(F.col("crawl").alias("c"), F.col("page").alias("p"))
    same = F.col("crawl").eqNullSafe(F.col("c"))
    breaks = standing.join(neighbour, same & (F.col("p") == page + 1), "left_anti").withColumn("side", F.lit("before"))
    resumes = standing.join(neighbour, same & (F.col("p") == page - 1), "left_anti").withColumn("side", F.lit("after"))
    order = Window.partitionBy("crawl").orderBy("page", "side")  # a run of one page ends the gap before it, then begins the next
    edges = breaks.unionByName(resumes).withColumn("next", F.lead("page").over(order))
    gaps = edges.filter((F.col("side") == "before") & F.col("next").isNotNull())
    return (
        rows(gaps, "missing", page + 1, F.col("next") - 1, none)
        .unionByName(rows(pages.filter("copies > 1"), "repeated", page, page, F.col("copies")))
        .unionByName(rows(pages.filter((page < first) | (page > F.col("end"))), "surplus", page, page, F.col("copies")))
        .unionByName(rows(ends.filter("end is null"), "no_end", F.col("low"), F.col("high"), none))
        .unionByName(rows(counted.filter("page is null"), "no_number", none, none, F.col("copies")))
    )
