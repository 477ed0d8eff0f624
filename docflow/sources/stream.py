"""Streaming document sources: Kafka topic in deployment, text files in tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return opts


def stream_documents(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream of JSON documents as one text column `value`.

    ``kafka``: the fixed Kafka schema, `value` BINARY cast to text (the key,
    partition, offset and timestamp are not used). ``text``: one document per line.
    """
    reader = spark.readStream.format(fmt)
    if options:
        reader = reader.options(**dict(options))
    df = reader.load(path) if path is not None else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def stream_records(
    spark: SparkSession,
    fmt: str,
    schema,
    path: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A file stream of records with a fixed schema (e.g. landed API pages as JSON lines)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if options:
        reader = reader.options(**dict(options))
    return reader.load(path)
