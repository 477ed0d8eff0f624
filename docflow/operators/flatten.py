"""Child-array flattening: row-local text, explode, ordered aggregate, re-attach.

The reference shape (explode -> groupBy id -> collect_list -> join back) costs
two shuffles and a join per array column, does not fix element order, and merges
the text of rows that share an id. ``flatten_text`` does the same job inside the
row: one Project, no Exchange, order kept. The other operators are the pieces
of the old shape, offered for flat (already exploded) inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.columns import DEFAULT_SEP, element_text, flatten_text_col

# Elements folded per partial string before the per-key merge in collect_concat.
CONCAT_BUCKET = 256


def flatten_text(
    df: DataFrame,
    array_col: str,
    out: str,
    value_field: str = "value",
    sep: str = DEFAULT_SEP,
    missing: str = "null",
) -> DataFrame:
    """Add `out` = element texts of `array_col` joined by `sep` (row-local, no shuffle).

    missing="null": NULL / empty arrays give NULL text (left-join semantics).
    missing="drop": such rows are removed (inner-join semantics).
    """
    if missing not in ("null", "drop"):
        raise ValueError("missing must be 'null' or 'drop'")
    res = df.withColumn(out, flatten_text_col(array_col, value_field, sep))
    if missing == "drop":
        res = res.filter(F.size(F.col(array_col)) > 0)
    return res


def explode_elements(
    df: DataFrame,
    key: str,
    array_col: str,
    value_field: str = "value",
    sep: str = DEFAULT_SEP,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per array element: (key, pos, text). Rows with NULL / empty arrays vanish.

    The position keeps element order through any later shuffle. ``posexplode_outer``
    plus a filter on the generated position, rather than ``posexplode``: for the
    latter Catalyst infers ``size(arr) > 0`` and pushes it below the projection that
    decodes the document, so every document would be parsed twice.
    """
    return (
        df.select(F.col(key), *[F.col(c) for c in keep], F.posexplode_outer(F.col(array_col)).alias("pos", "__elem"))
        .filter(F.col("pos").isNotNull())
        .select(F.col(key), *keep, "pos", element_text(F.col("__elem"), value_field, sep).alias("text"))
    )


def collect_concat(
    df: DataFrame,
    key: str,
    value: str,
    pos: str = "pos",
    out: str = "text",
    sep: str = DEFAULT_SEP,
    bucket: int = CONCAT_BUCKET,
) -> DataFrame:
    """Per key, `value` strings joined by `sep` in `pos` order (pos: dense integer position).

    Two aggregation levels so that one hot key is never gathered element by element
    into one task: first (key, pos div bucket) folds up to `bucket` elements into one
    partial string (spread over many tasks), then the key merges its partial strings
    in bucket order. Sorting by position makes the result deterministic, which a bare
    ``collect_list`` is not once the hash aggregate falls back to sort-based mode.

    The last level holds ceil(n / bucket) partial strings for a key with n elements;
    its input is no larger than the one output value that key must produce anyway
    (a single string, at most 2 GB), so it stays bounded by the result, not the input.

    NULL values are skipped; a key with NULL values only gives ''. Rows with a NULL key have
    no document to go back to and are left out before the grouping.
    """
    b = F.floor(F.col(pos) / F.lit(bucket)).alias("__b")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(value)))), lambda x: x.getField(value))
    present = F.filter(ordered, lambda v: v.isNotNull())
    # a fold of NULLs only is NULL, which the next level skips: the text does not depend on `bucket`
    partial = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key), b)
        .agg(F.when(F.size(present) > 0, F.array_join(present, sep)).alias("__part"))
    )
    return partial.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("__b", "__part"))), lambda x: x["__part"]),
            sep,
        ).alias(out)
    )


def attach_text(base: DataFrame, texts: DataFrame, key: str = "_id", how: str = "left") -> DataFrame:
    """Join per-key text back to the documents (USING form: one key column out).

    `texts` is unique per key (output of ``collect_concat``), so the join cannot fan out;
    it is a shuffle join on the key, and AQE may turn it into a broadcast at run time
    when the text side is measured small.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    return base.join(texts, on=key, how=how)

