"""JSON decode against a fixed schema, with a quarantine for documents that fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

_DOC = "__doc"


def as_text(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Binary payload (e.g. a Kafka `value`) -> UTF-8 text column `value`."""
    c = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, BinaryType):
        c = c.cast("string")
    return df.select(c.alias("value"))


def parse(
    df: DataFrame, schema: StructType, value_col: str = "value", keep_raw: bool = False, key: str = "_id"
) -> DataFrame:
    """Permissive ``from_json`` then star-expansion of the document struct.

    A field whose JSON type does not fit its declared type decodes to NULL and the
    rest of the document survives; malformed text and NULL input give all-NULL rows.
    `keep_raw` adds `raw_value`, the input text of rows whose `key` failed to decode
    (NULL for good rows, so a persisted batch does not carry every document twice).
    """
    # The document is expanded by a generator (inline of a one-element array) rather
    # than a Project: predicates on its fields then stay above the decode, whereas
    # through a Project Catalyst substitutes from_json into each pushed-down filter
    # and parses every document once more per filter.
    doc = F.inline(F.array(F.from_json(F.col(value_col), schema)))
    if not keep_raw:
        return df.select(doc)
    parsed = df.select(doc, F.col(value_col).alias("__raw"))
    names = [f.name for f in schema.fields]
    raw = F.when(F.col(key).isNull(), F.col("__raw")).alias("raw_value")
    return parsed.select(*[F.col(f"`{n}`") for n in names], raw)


def is_valid(key: str = "_id") -> Column:
    return F.col(key).isNotNull()


def decode_documents(
    df: DataFrame, schema: StructType, value_col: str = "value", key: str = "_id"
) -> tuple[DataFrame, DataFrame]:
    """Split decoded documents into (valid, quarantine).

    A document is valid when its key decodes to a non-NULL value. Quarantined rows
    keep the raw text so they can be inspected or replayed. Both outputs come from
    one parse; callers writing both should ``persist`` the parsed frame first
    (see ``split_parsed``) so the text is decoded once.
    """
    parsed = parse(df, schema, value_col, keep_raw=True, key=key)
    return split_parsed(parsed, key)


def split_parsed(parsed: DataFrame, key: str = "_id") -> tuple[DataFrame, DataFrame]:
    valid = parsed.filter(is_valid(key)).drop("raw_value")
    quarantine = parsed.filter(~is_valid(key)).select(
        F.col("raw_value"),
        F.when(F.col("raw_value").isNull(), F.lit("null_input"))
        .otherwise(F.lit("missing_or_invalid_key"))
        .alias("reason"),
    )
    return valid, quarantine


def decode_column(df: DataFrame, json_col: str, schema: StructType | str, alias: str | None = None) -> DataFrame:
    """Decode one JSON text column in place (other columns kept)."""
    return df.withColumn(alias or json_col, F.from_json(F.col(json_col), schema))
