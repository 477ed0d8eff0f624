"""Registered queries on documents: inferred schema, decode losses, completeness of crawls; with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.losses import decode_errors
from docflow.schemas import JOB_SCHEMA
from docflow.session import scratch_path
from docflow.sources import driver_tables as dt
from docflow.sources.inferred import scan_inferred


def _by_status(docs: DataFrame, finished: dict[str, Column], open_job: dict[str, Column]) -> DataFrame:
    """Documents as JSON text in one pass: finished and open jobs with some fields of another type, all others as they are."""

    def text(changed: dict[str, Column]) -> Column:
        return F.to_json(F.struct(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns]))

    status = F.col("content")
    return docs.select(F.when(status == "F", text(finished)).when(status == "O", text(open_job)).otherwise(text({})).alias("value"))


def q_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job documents of a collection without a declared schema: `skills_str` is a number in finished
    jobs and text in others, `salary.value` an object in open ones."""
    docs = dt.job_documents(spark, sf_dir)
    salary = F.struct(F.col("salary.is_negotiable").alias("is_negotiable"), F.struct(F.col("title").alias("range")).alias("value"))
    path = scratch_path(spark, "jobs_collection")
    _by_status(docs, {"skills_str": F.col("owned_id")}, {"salary": salary}).write.text(f"{path}/part=0")
    found, _, inferred = scan_inferred(spark, f"{path}/*")
    kinds = {f.name: f.dataType.simpleString() for f in inferred.schema.fields}
    return found.select(
        F.col("_id").alias("id"), "title", F.col("skills_str").alias("skills"), F.col("salary.value").alias("salary"),
        F.col("inserted_at.$date").alias("millis"), F.size("requirements_arr").cast("long").alias("n_requirements"),
        F.lit(kinds["skills_str"]).alias("skills_type"), F.lit(kinds["_id"]).alias("id_type"), F.lit(",".join(inferred.conflicts)).alias("conflicts"),
    )


def q_decode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fields of other types than declared: an owner as text, a date as text, a number with a
    fraction sign among the benefits, a salary that is no object. Every lost field is a row."""
    docs = dt.job_documents(spark, sf_dir)
    finished = {"owned_id": F.concat(F.lit("owner-"), F.col("owned_id").cast("string")), "salary": F.col("title")}
    halves = F.transform("benefits", lambda b: F.struct((b["id"] / 2).alias("id"), b["value"].alias("value")))
    open_job = {"inserted_at": F.struct(F.col("detail_url").alias("$date")), "benefits": halves}
    text = _by_status(docs, finished, open_job)
    return decode_errors(text, JOB_SCHEMA)


_LINES = """
    SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) - 1 AS pos FROM lineitem
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_inferred": q_scan_inferred,
    "decode_errors": q_decode_errors,
}

ORACLE: dict[str, str] = {
    "scan_inferred": """
        SELECT o_orderkey AS id, o_orderpriority AS title,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS skills,
               CASE WHEN o_orderstatus = 'O' THEN '{"range":"' || o_orderpriority || '"}' ELSE o_orderstatus END AS salary,
               epoch_ms(o_orderdate) AS millis, n AS n_requirements,
               'string' AS skills_type, 'bigint' AS id_type, 'salary.value,skills_str' AS conflicts
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    """,
    "decode_errors": f"""
        SELECT o_orderkey AS _id, '$.owned_id' AS path, '"owner-' || CAST(o_custkey AS VARCHAR) || '"' AS raw_value FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, '$.salary', '"' || o_orderpriority || '"' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, '$.inserted_at.$date', '"/jobs/' || CAST(o_orderkey AS VARCHAR) || '"' FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT o_orderkey, '$.benefits[' || CAST(pos AS VARCHAR) || '].id', CAST(l_linenumber // 2 AS VARCHAR) || CASE WHEN l_linenumber % 2 = 1 THEN '.5' ELSE '' END
        FROM orders JOIN ({_LINES}) ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'
    """,
}
