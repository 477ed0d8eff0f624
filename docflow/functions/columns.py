"""Scalar column expressions used by the operators.

All of them are plain Catalyst expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source system's output) -------------------
# Label written in place of the salary text when the negotiable flag is 1
# (Vietnamese for "negotiable"), UTF-8.
NEGOTIABLE_LABEL = "Thương lượng"
# Separator used between array elements and between inner values.
DEFAULT_SEP = ", "
# -----------------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_of(arr: Column | str) -> Column:
    """First array element, NULL for a NULL or empty array (``arr[0]`` throws under ANSI)."""
    return F.get(_c(arr), F.lit(0))


def try_int(col: Column | str) -> Column:
    """String -> INT as Spark 3.5 casts it: a plain decimal gives its whole part, other text NULL (``cast`` throws under ANSI)."""
    whole = F.regexp_extract(F.trim(_c(col).cast("string")), r"^([+-]?[0-9]+)\.[0-9]*$", 1)
    return F.coalesce(_c(col).try_cast("int"), whole.try_cast("int"))


def negotiable_label(flag: Column | str, value: Column | str, label: str = NEGOTIABLE_LABEL) -> Column:
    """Label when the flag reads as the integer 1, else the raw value."""
    return F.when(try_int(flag) == 1, F.lit(label)).otherwise(_c(value))


def epoch_millis_to_ts(millis: Column | str) -> Column:
    """Epoch milliseconds -> UTC wall-clock TIMESTAMP_NTZ, exact to the millisecond.

    Independent of the session time zone, and no trip through DOUBLE.
    """
    return F.timestamp_add("MILLISECOND", _c(millis), F.expr(_EPOCH_NTZ))


def ts_to_epoch_millis(ts: Column | str) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> epoch milliseconds (inverse of the above)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(ts))


def element_text(elem: Column, value_field: str = "value", sep: str = DEFAULT_SEP) -> Column:
    """Text of one array element: its `value` joined with `sep`.

    An array value skips NULL inner items; a NULL element or NULL scalar gives ''.
    """
    return F.concat_ws(sep, elem.getField(value_field))


def flatten_text_col(arr: Column | str, value_field: str = "value", sep: str = DEFAULT_SEP) -> Column:
    """Row-local flatten: element texts joined with `sep`; NULL for a NULL or empty array."""
    a = _c(arr)
    joined = F.array_join(F.transform(a, lambda e: element_text(e, value_field, sep)), sep)
    return F.when(F.size(a) > 0, joined)
