"""Column-level functions (all built-in Spark expressions, whole-stage codegen friendly)."""

from docflow.functions.columns import (
    NEGOTIABLE_LABEL,
    element_text,
    epoch_millis_to_ts,
    first_of,
    flatten_text_col,
    negotiable_label,
    try_int,
    ts_to_epoch_millis,
)

__all__ = [
    "NEGOTIABLE_LABEL",
    "element_text",
    "epoch_millis_to_ts",
    "first_of",
    "flatten_text_col",
    "negotiable_label",
    "try_int",
    "ts_to_epoch_millis",
]
