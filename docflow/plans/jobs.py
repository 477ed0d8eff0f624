"""Job documents -> flat `jobs` table.

``jobs_table`` is the streaming job's per-batch transform (11 columns): both child
arrays flattened inside the row, negotiable label, epoch-millis dates. One Project
over the decoded documents: no shuffle, one parse.
``jobs_batch_table`` is the older batch variant (10 columns): inner semantics on
requirements (documents without them dropped), raw salary text, no benefits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.columns import DEFAULT_SEP, epoch_millis_to_ts, flatten_text_col, negotiable_label
from docflow.schemas import JOBS_BATCH_COLUMNS, JOBS_STREAM_COLUMNS


def _date(field: str):
    return epoch_millis_to_ts(F.col(field).getField("$date"))


def jobs_table(docs: DataFrame, sep: str = DEFAULT_SEP) -> DataFrame:
    """Decoded job documents -> id, title, content, owned_id, skills, url,
    requirement, benefit, inserted_at, updated_at, salary."""
    out = docs.select(
        F.col("_id").alias("id"),
        "title",
        "content",
        "owned_id",
        F.col("skills_str").alias("skills"),
        F.col("detail_url").alias("url"),
        flatten_text_col("requirements_arr", "value", sep).alias("requirement"),
        flatten_text_col("benefits", "value", sep).alias("benefit"),
        _date("inserted_at").alias("inserted_at"),
        _date("updated_at").alias("updated_at"),
        negotiable_label(F.col("salary.is_negotiable"), F.col("salary.value")).alias("salary"),
    )
    return out.select(*JOBS_STREAM_COLUMNS)


def jobs_batch_table(docs: DataFrame, sep: str = DEFAULT_SEP) -> DataFrame:
    """Batch variant: documents without requirements are dropped; salary is the raw text."""
    out = docs.filter(F.size("requirements_arr") > 0).select(
        F.col("_id").alias("id"),
        "title",
        "content",
        "owned_id",
        F.col("skills_str").alias("skills"),
        F.col("salary.value").alias("salary"),
        F.col("detail_url").alias("url"),
        flatten_text_col("requirements_arr", "value", sep).alias("requirement"),
        _date("inserted_at").alias("inserted_at"),
        _date("updated_at").alias("updated_at"),
    )
    return out.select(*JOBS_BATCH_COLUMNS)


JOBS_BATCH_SQL = """
SELECT
    j._id            AS id,
    j.title,
    j.content,
    j.owned_id,
    j.skills_str     AS skills,
    j.salary.value   AS salary,
    j.detail_url     AS url,
    r.requirement,
    j.inserted_at,
    j.updated_at
FROM {jobs} j
INNER JOIN {requirements} r ON j._id = r._id
"""


def jobs_batch_sql(spark, docs: DataFrame, sep: str = DEFAULT_SEP, jobs_view: str = "jobs",
                   req_view: str = "requirements") -> DataFrame:
    """The batch variant in its original shape: ordered per-id requirement text from an
    explode + aggregate, joined back in SQL with an INNER JOIN (documents without
    requirements drop out). Dates are converted before the view so the SQL sees timestamps.

    Costs two aggregation shuffles and a join against ``jobs_batch_table``'s none; kept
    for users whose requirement text comes from a separate, already flat table.
    """
    from docflow.operators.flatten import collect_concat, explode_elements

    texts = collect_concat(explode_elements(docs, "_id", "requirements_arr", sep=sep), "_id", "text",
                           out="requirement", sep=sep)
    docs.withColumn("inserted_at", _date("inserted_at")).withColumn(
        "updated_at", _date("updated_at")
    ).createOrReplaceTempView(jobs_view)
    texts.createOrReplaceTempView(req_view)
    return spark.sql(JOBS_BATCH_SQL.format(jobs=jobs_view, requirements=req_view))
