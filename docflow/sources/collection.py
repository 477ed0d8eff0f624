"""Batch scan of a document collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_collection(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | None = None,
    options: Mapping[str, str] | None = None,
    view: str | None = None,
) -> DataFrame:
    """Read a collection as a DataFrame, optionally registering it as a temp view.

    `fmt` is any DataSource name: ``mongodb`` in deployment (collection/database
    in `options`), ``json`` / ``parquet`` on files. Pass `schema` whenever it is
    known: inference reads (a sample of) the data once more before the query runs.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**dict(options))
    df = reader.load(path) if path is not None else reader.load()
    if view:
        df.createOrReplaceTempView(view)
    return df


def document_store_options(database: str, collection: str, uri: str | None = None) -> dict[str, str]:
    """Options for the MongoDB Spark connector (jar supplied by the deployment)."""
    opts = {"database": database, "collection": collection}
    if uri:
        opts["connection.uri"] = uri
    return opts
