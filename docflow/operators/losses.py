"""Which fields a typed decode loses: every value that is in the document and not in the decoded row.

A permissive decode gives NULL for a field whose JSON type does not fit its declared type, and
nobody sees it. Here the text is also parsed to a VARIANT, and both are walked side by side: a value
that is present, not a JSON null, and NULL in the decoded row is a loss, named by its path with its raw
JSON. Where a whole array or object is NULL, the loss is the array or object, not each part of
it. Fields that the schema does not declare are left out on purpose and are no losses.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

LOSSES = "array<struct<path:string,raw_value:string>>"
# Field names that a VARIANT path takes as they are.
PLAIN_NAME = re.compile(r"[\w$]+")


def is_object(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "map<string,variant>").isNotNull()


def _none() -> Column:
    return F.array().cast(LOSSES)


def _one(path: Column, raw: Column) -> Column:
    return F.array(F.struct(path.alias("path"), F.to_json(raw).alias("raw_value"))).cast(LOSSES)


def _at(raw: Column, steps: str) -> Column:
    return raw if steps == "$" else F.try_variant_get(raw, steps, "variant")


def _field(raw: Column, steps: str, name: str) -> tuple[Column, str]:
    """The field `name` of the object at `steps`: by a longer path, or by key where a path cannot spell the name."""
    if PLAIN_NAME.fullmatch(name):
        return raw, f"{steps}.{name}"
    return F.try_variant_get(raw, steps, "map<string,variant>")[name], "$"


def has_null(typed: Column, kind: DataType) -> Column:
    """Whether ``typed`` or anything in it is NULL: where nothing is, nothing can be lost."""
    found = typed.isNull()
    if isinstance(kind, StructType):
        for f in kind.fields:
            found = found | has_null(typed[f.name], f.dataType)
    elif isinstance(kind, ArrayType):
        found = found | F.exists(typed, lambda e: has_null(e, kind.elementType))
    elif isinstance(kind, MapType):
        found = found | F.exists(F.map_values(typed), lambda e: has_null(e, kind.valueType))
    return found


def losses(raw: Column, typed: Column, kind: DataType, path: Column, steps: str = "$") -> Column:
    """Array of (path, raw_value) of what ``typed`` (of type ``kind``) lacks of the value at ``steps`` in the VARIANT ``raw``.

    The VARIANT is read only where ``typed`` is NULL, or for an array or a map with a NULL in it.
    """
    if isinstance(kind, StructType):
        parts = [losses(base, typed[f.name], f.dataType, F.concat(path, F.lit("." + f.name)), at) for f in kind.fields for base, at in [_field(raw, steps, f.name)]]
        inner = F.concat(*parts) if parts else _none()
    elif isinstance(kind, ArrayType):
        elements = F.try_variant_get(raw, steps, "array<variant>")
        found = F.flatten(F.transform(elements, lambda e, i: losses(e, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        inner = F.when(has_null(typed, kind), F.coalesce(found, _none())).otherwise(_none())
    elif isinstance(kind, MapType):
        entries = F.map_entries(F.try_variant_get(raw, steps, "map<string,variant>"))
        found = F.flatten(F.transform(entries, lambda e: losses(e["value"], typed[e["key"]], kind.valueType, F.concat(path, F.lit("."), e["key"]))))
        inner = F.when(has_null(typed, kind), F.coalesce(found, _none())).otherwise(_none())
    else:
        inner = _none()
    # as a string, a JSON null and an absent value are both NULL
    lost = F.when(F.try_variant_get(raw, steps, "string").isNotNull(), _one(path, _at(raw, steps))).otherwise(_none())
    return F.when(typed.isNull(), lost).otherwise(inner)


def parse_with_losses(df: DataFrame, schema: StructType, value_col: str = "value", lost: str = "lost") -> DataFrame:
    """``parse`` with a column ``lost``: the fields that the decode dropped from each document.

    One typed decode and one VARIANT parse for each document, no shuffle. Text that is no JSON object has the one loss ``$``
    with the text itself; a NULL input or a JSON null has none.
    """
    both = df.select(F.inline(F.array(F.struct(F.from_json(F.col(value_col), schema).alias("__doc"), F.try_parse_json(F.col(value_col)).alias("__variant"), F.col(value_col).alias("__text")))))
    unread = F.array(F.struct(F.lit("$").alias("path"), F.col("__text").alias("raw_value"))).cast(LOSSES)
    found = (
        F.when(F.col("__text").isNull(), _none())
        .when(F.col("__variant").isNull(), unread)
        # text, a number or an array in place of the document
        .when(~is_object(F.col("__variant")), losses(F.col("__variant"), F.lit(None).cast("string"), StringType(), F.lit("$")))
        .otherwise(losses(F.col("__variant"), F.col("__doc"), schema, F.lit("$")))
    )
    return both.select("__doc.*", F.coalesce(found, _none()).alias(lost))


def decode_errors(df: DataFrame, schema: StructType, value_col: str = "value", key: str = "_id") -> DataFrame:
    """A row (key, path, raw_value) for every field lost; the key is NULL where it was lost itself."""
    parsed = parse_with_losses(df, schema, value_col, "__lost")
    return parsed.select(F.col(f"`{key}`"), F.inline("__lost"))
