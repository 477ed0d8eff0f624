"""Landed API responses -> one row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from docflow.schemas import page_envelope


def page_unwrap(
    pages: DataFrame,
    doc_schema: StructType,
    body_col: str = "body",
    keep: tuple[str, ...] = ("page",),
    id_field: str = "id",
    key: str = "_id",
) -> DataFrame:
    """Decode each page body ``{data: [...], meta: {...}}`` and emit its documents.

    `doc_schema` describes a document as the API returns it (key named `id_field`);
    the key is renamed to `key`. Pages with empty or missing `data` emit nothing here, and
    neither do pages that do not decode: ``page_items`` returns those as a quarantine.
    Row-local (decode + generate): no shuffle.
    """
    env = page_envelope(doc_schema)
    return (
        pages.select(*keep, F.explode(F.from_json(F.col(body_col), env).getField("data")).alias("__d"))
        .select(*keep, "__d.*")
        .withColumnRenamed(id_field, key)
    )


ITEMS = "data ARRAY<MAP<STRING, STRING>>"


def decode_pages(pages: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ("page",)) -> DataFrame:
    """``keep``, the items of each page as maps, and the text and reason of a page without items to decode.

    The one decode of each body; what reads the result twice should persist it. The generator keeps filters on the
    decoded columns above the decode.
    """
    body, text = F.col(body_col), F.col("__body")
    why = (
        F.when(text.isNull(), F.lit("null_input"))
        .when(F.try_parse_json(text).isNull(), F.lit("malformed_page"))
        .otherwise(F.lit("no_data"))
    )
    decoded = pages.select(*keep, F.inline(F.array(F.struct(F.from_json(body, ITEMS).getField("data").alias("__data"), body.alias("__body")))))
    unread = F.col("__data").isNull()
    return decoded.select(*keep, "__data", F.when(unread, text).alias("__raw"), F.when(unread, why).alias("__reason"))


def page_items(
    pages: DataFrame,
    doc_schema: StructType,
    body_col: str = "body",
    keep: tuple[str, ...] = ("page",),
    id_field: str = "id",
    key: str = "_id",
) -> tuple[DataFrame, DataFrame]:
    """(items, quarantine) of landed pages, no field lost.

    An item is its key and `doc`, the map of all fields the item carries (an explicit null is an
    entry, an absent field is none; nested values are JSON text). Quarantine keeps the text of what
    cannot be stored, with the reason: a page that does not decode or has no `data`, and an item
    without a readable key. A page with an empty `data` array gives no rows on either side.
    """
    return split_items(decode_pages(pages, body_col, keep), doc_schema, keep, id_field, key)


def split_items(decoded: DataFrame, doc_schema: StructType, keep: tuple[str, ...] = ("page",), id_field: str = "id", key: str = "_id") -> tuple[DataFrame, DataFrame]:
    """(items, quarantine) of ``decode_pages`` output."""
    key_type = doc_schema[id_field].dataType
    exploded = decoded.select(*keep, F.explode("__data").alias("__d"))
    items = exploded.select(*keep, typed_field(F.col("__d"), id_field, key_type).alias(key), F.map_filter("__d", lambda k, v: k != id_field).alias("doc"))
    bad_pages = decoded.filter(F.col("__reason").isNotNull()).select(*keep, F.col("__raw").alias("raw_value"), F.col("__reason").alias("reason"))
    keyless = exploded.filter(typed_field(F.col("__d"), id_field, key_type).isNull())
    bad_items = keyless.select(*keep, F.to_json("__d").alias("raw_value"), F.lit("missing_or_invalid_key").alias("reason"))
    return items.filter(F.col(key).isNotNull()), bad_pages.unionByName(bad_items)


def typed_field(doc: Column, field: str, data_type) -> Column:
    """Field of a map document in its declared type; NULL when absent, null or malformed."""
    text = doc.getItem(field)
    if isinstance(data_type, StringType):
        return text
    if isinstance(data_type, (StructType, ArrayType, MapType)):
        return F.from_json(text, data_type)
    return text.try_cast(data_type)


def last_page(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """`meta.last_page` of each page (what the crawler follows)."""
    return pages.select(F.get_json_object(F.col(body_col), "$.meta.last_page").cast("int").alias("last_page"))
