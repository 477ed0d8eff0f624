"""Scan of a document collection whose schema is inferred from all of its documents.

Inference is an aggregate over every document, without sampling: each task folds the types of its
documents into one, and only those partial types are shuffled. The rule for a field, at any depth:

- whole numbers are BIGINT, other numbers DECIMAL wide enough for all of them, DOUBLE where one has an exponent;
- objects and arrays are merged field by field and element by element;
- a field whose kinds conflict (number in one document, text or object in another) is text: the string itself, or
  the JSON text of any other value, so no document loses it;
- a field that is only ever null, or an object that never has a field, is text too.

Rows that hold no JSON object take no part and go to the quarantine with their text and the reason.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructField, StructType, VariantType

from docflow.operators.decode import parse
from docflow.operators.losses import is_object

_OUTSIDE_NAMES = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


@dataclass(frozen=True)
class InferredSchema:
    """Schema of a collection, and the paths of the fields that are text because their kinds conflict."""

    schema: StructType
    conflicts: tuple[str, ...]


def _settled(kind: DataType, path: str, conflicts: list[str]) -> DataType:
    if isinstance(kind, StructType) and kind.fields:
        return StructType([StructField(f.name, _settled(f.dataType, f"{path}.{f.name}" if path else f.name, conflicts)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType, path + "[]", conflicts))
    if isinstance(kind, VariantType):
        conflicts.append(path)
    return StringType() if isinstance(kind, (VariantType, NullType, StructType)) else kind


def infer_schema(docs: DataFrame, value_col: str = "value") -> InferredSchema:
    """Schema of all JSON objects in a text column; raises if there is none."""
    variant = F.try_parse_json(F.col(value_col))
    merged = docs.select(variant.alias("__v")).filter(is_object(F.col("__v"))).agg(F.schema_of_variant_agg("__v").alias("s")).first()["s"]
    if not merged.startswith("OBJECT<"):
        raise ValueError("the collection holds no JSON object to infer a schema from")
    kind = DataType.fromDDL(_OUTSIDE_NAMES.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], merged))
    conflicts: list[str] = []
    settled = _settled(kind, "", conflicts)
    if not isinstance(settled, StructType):
        raise ValueError("no document of the collection has a field")
    return InferredSchema(settled, tuple(conflicts))


def decode_inferred(docs: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame, InferredSchema]:
    """(documents, quarantine, schema): one pass to infer, one to decode, which happens when the frames are used."""
    inferred = infer_schema(docs, value_col)
    variant = F.try_parse_json(F.col(value_col))
    reason = (
        F.when(F.col(value_col).isNull(), F.lit("null_input"))
        .when(variant.isNull(), F.lit("malformed"))
        .when(~is_object(variant), F.lit("not_an_object"))
    )
    judged = docs.select(F.col(value_col).alias("value"), reason.alias("reason"))
    good = parse(judged.filter(F.col("reason").isNull()), inferred.schema)
    return good, judged.filter(F.col("reason").isNotNull()).select(F.col("value").alias("raw_value"), "reason"), inferred


def scan_inferred(spark: SparkSession, path: str, view: str | None = None) -> tuple[DataFrame, DataFrame, InferredSchema]:
    """Collection landed as text files, one JSON document a line; optionally a temp view of the documents."""
    docs, bad, inferred = decode_inferred(spark.read.text(path))
    if view:
        docs.createOrReplaceTempView(view)
    return docs, bad, inferred
