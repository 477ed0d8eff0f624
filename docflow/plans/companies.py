"""Company documents -> flat `companies` table, in SQL over a temp view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COMPANIES_SQL = """
SELECT
    _id                              AS id,
    image_logo                       AS image,
    display_name                     AS name,
    company_size                     AS size,
    num_employees,
    industries_str                   AS industry,
    nationalities_str                AS nationality,
    get(addresses.full_addresses, 0) AS address,
    detail_url                       AS url,
    inserted_at,
    updated_at
FROM {view}
"""


def companies_table(spark: SparkSession, docs: DataFrame, view: str = "companies") -> DataFrame:
    """Register the collection as `view` and project it; first address or NULL.

    ``get(arr, 0)`` instead of ``arr[0]``: under ANSI mode the latter throws on an
    empty array. Project only: the scan reads just the fields used.
    """
    docs.createOrReplaceTempView(view)
    return spark.sql(COMPANIES_SQL.format(view=view))
