"""Fixed document schemas and output column orders."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _date_wrapper() -> StructType:
    # extended-JSON date: {"$date": <epoch millis>}
    return StructType([StructField("$date", LongType())])


# Job document. `_id` and `owned_id` are widened from INT to BIGINT so that keys
# past 2^31 still decode (every INT value decodes to the same number); `skills_str`
# is text, as its name and the companies' `industries_str` say.
JOB_SCHEMA = StructType(
    [
        StructField("_id", LongType()),
        StructField("applied", StringType()),
        StructField("title", StringType()),
        StructField("content", StringType()),
        StructField("detail_url", StringType()),
        StructField("inserted_at", _date_wrapper()),
        StructField("updated_at", _date_wrapper()),
        StructField("owned_id", LongType()),
        StructField("skills_str", StringType()),
        StructField(
            "requirements_arr",
            ArrayType(
                StructType(
                    [
                        StructField("value", ArrayType(StringType())),
                        StructField("icon", StringType()),
                    ]
                )
            ),
        ),
        StructField(
            "salary",
            StructType(
                [
                    StructField(name, StringType())
                    for name in (
                        "is_negotiable",
                        "unit",
                        "min",
                        "max",
                        "currency",
                        "min_estimate",
                        "max_estimate",
                        "currency_estimate",
                        "value",
                    )
                ]
            ),
        ),
        StructField(
            "benefits",
            ArrayType(
                StructType(
                    [
                        StructField("id", IntegerType()),
                        StructField("name", StringType()),
                        StructField("value", StringType()),
                    ]
                )
            ),
        ),
    ]
)

COMPANY_SCHEMA = StructType(
    [
        StructField("_id", LongType()),
        StructField("image_logo", StringType()),
        StructField("display_name", StringType()),
        StructField("company_size", StringType()),
        StructField("num_employees", StringType()),
        StructField("industries_str", StringType()),
        StructField("nationalities_str", StringType()),
        StructField("addresses", StructType([StructField("full_addresses", ArrayType(StringType()))])),
        StructField("detail_url", StringType()),
        StructField("inserted_at", TimestampNTZType()),
        StructField("updated_at", TimestampNTZType()),
    ]
)


def page_envelope(doc_schema: StructType) -> StructType:
    """API page body: {"data": [doc with `id`], "meta": {"last_page": n}}."""
    return StructType(
        [
            StructField("data", ArrayType(doc_schema)),
            StructField("meta", StructType([StructField("last_page", IntegerType())])),
        ]
    )


def change_event(doc_schema: StructType) -> StructType:
    """Change-stream envelope; `fullDocument` is NULL for deletes."""
    return StructType(
        [
            StructField("operationType", StringType()),
            StructField("fullDocument", doc_schema),
        ]
    )


# Output tables, columns in order.
JOBS_STREAM_COLUMNS = [
    "id", "title", "content", "owned_id", "skills", "url",
    "requirement", "benefit", "inserted_at", "updated_at", "salary",
]
JOBS_BATCH_COLUMNS = [
    "id", "title", "content", "owned_id", "skills", "salary",
    "url", "requirement", "inserted_at", "updated_at",
]
COMPANIES_COLUMNS = [
    "id", "image", "name", "size", "num_employees", "industry",
    "nationality", "address", "url", "inserted_at", "updated_at",
]


def prune(schema: StructType, paths: list[str]) -> StructType:
    """Sub-schema holding only the dotted `paths` (arrays of structs are descended).

    Decoding with it makes the JSON parser skip unused fields instead of building
    them; Catalyst does not prune ``from_json`` once the document is referenced twice.
    """
    from pyspark.sql.types import ArrayType as _A

    tree: dict = {}
    for p in paths:
        node = tree
        for part in p.split("."):
            node = node.setdefault(part, {})

    def cut(dt, node):
        if not node:
            return dt
        if isinstance(dt, _A):
            return _A(cut(dt.elementType, node), dt.containsNull)
        if isinstance(dt, StructType):
            missing = set(node) - set(dt.fieldNames())
            if missing:
                raise ValueError(f"unknown fields {sorted(missing)}")
            return StructType(
                [StructField(f.name, cut(f.dataType, node[f.name]), f.nullable) for f in dt.fields if f.name in node]
            )
        raise ValueError(f"cannot descend into {dt.simpleString()}")

    return cut(schema, tree)


# Fields the jobs tables read; decode with this to skip the rest of each document.
JOB_FIELDS_USED = [
    "_id", "title", "content", "detail_url", "inserted_at", "updated_at", "owned_id", "skills_str",
    "requirements_arr.value", "salary.is_negotiable", "salary.value", "benefits.value",
]
