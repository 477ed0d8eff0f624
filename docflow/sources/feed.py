"""Change feed: keep chosen operation types and emit the full document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_feed(
    events: DataFrame,
    operations: Sequence[str] = ("insert",),
    op_col: str = "operationType",
    doc_col: str = "fullDocument",
) -> DataFrame:
    """Filter change events to `operations` and project the document fields.

    Default is insert-only, as the deployed connector is configured; pass
    ``("insert", "update", "replace")`` to let later versions through to an upsert.
    Chosen events without a document (updates, when the connector looks none up) have no
    document to emit; ``events_without_document`` returns them.
    The filter is the first operator over the source so it is pushed to the scan.
    """
    return events.filter(_chosen(operations, op_col) & F.col(doc_col).isNotNull()).select(f"{doc_col}.*")


def events_without_document(
    events: DataFrame,
    operations: Sequence[str] = ("insert",),
    op_col: str = "operationType",
    doc_col: str = "fullDocument",
) -> DataFrame:
    """The chosen events that ``insert_feed`` cannot emit, whole, to look their documents up."""
    return events.filter(_chosen(operations, op_col) & F.col(doc_col).isNull())


def _chosen(operations: Sequence[str], op_col: str):
    ops = list(operations)
    return F.col(op_col) == ops[0] if len(ops) == 1 else F.col(op_col).isin(ops)
