"""Keyed upsert: latest value per field, first-insert and last-update times.

Semantics of the document store's ``update_one({_id}, {$set: {...item, updated_at: now},
$setOnInsert: {inserted_at: now}}, upsert=True)`` applied to a history of items:

* every field present in a later item replaces the stored value (an explicit
  JSON null replaces it with NULL);
* a field absent from an item keeps its stored value (``roll_up_fields``);
* ``inserted_at`` is the time of the first item, ``updated_at`` of the last.

Roll-ups are aggregates (``max_by`` / ``min`` / ``max`` / ``bool_or``), so Spark
combines map-side before the shuffle and a hot key never gathers its raw rows in
one task. A merge joins two roll-ups, each unique per key, with a full outer join:
no key can fan out or skew, and when the stored side is bucketed by the key
(``docflow.sinks.keyed_store``) only the delta is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED = "inserted_at"
UPDATED = "updated_at"


def _order(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_by])


def roll_up(
    df: DataFrame, key: str, fields: Sequence[str], order_by: Sequence[str], time_col: str
) -> DataFrame:
    """Whole-document upsert of a history: each field's value from the latest item."""
    order = _order(order_by)
    return df.groupBy(key).agg(
        *[F.max_by(F.col(f), order).alias(f) for f in fields],
        F.min(time_col).alias(INSERTED),
        F.max(time_col).alias(UPDATED),
    )


def split_keyless(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without): a row without a key cannot be upserted, its caller puts it aside."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def _with_keys(df: DataFrame, key: str) -> DataFrame:
    """`df`, failing at run time on a NULL key (a filter: the partitioning by the key is kept)."""
    return df.filter(F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL {key} in an upsert; use split_keyless")).cast("boolean")).otherwise(True))


def _pair(target: DataFrame, delta: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Both sides by key. NULL keys never match in a join and would add a row with each merge, so they are an error."""
    target, delta = _with_keys(target, key), _with_keys(delta, key)
    t = target.select(key, *[F.col(c).alias(f"t__{c}") for c in cols], F.lit(True).alias("t__in"))
    d = delta.select(key, *[F.col(c).alias(f"d__{c}") for c in cols], F.lit(True).alias("d__in"))
    return t.join(d, on=key, how="full_outer")


def merge(target: DataFrame, delta: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Apply a rolled-up delta (later) to a rolled-up target (earlier); both unique per key.

    A key in the delta takes the delta's document; ``inserted_at`` stays the target's
    when the key existed; ``updated_at`` comes from the delta when present.
    """
    cols = [*fields, INSERTED, UPDATED]
    j = _pair(target, delta, key, cols)
    in_d = F.coalesce(F.col("d__in"), F.lit(False))
    return j.select(
        key,
        *[F.when(in_d, F.col(f"d__{f}")).otherwise(F.col(f"t__{f}")).alias(f) for f in fields],
        F.coalesce(F.col(f"t__{INSERTED}"), F.col(f"d__{INSERTED}")).alias(INSERTED),
        F.when(in_d, F.col(f"d__{UPDATED}")).otherwise(F.col(f"t__{UPDATED}")).alias(UPDATED),
    )


def has(field: str) -> str:
    return f"has_{field}"


def roll_up_fields(
    df: DataFrame,
    key: str,
    doc_col: str,
    fields: Sequence[str],
    order_by: Sequence[str],
    time_col: str,
) -> DataFrame:
    """Field-level ``$set`` over partial documents held as ``map<string,string>`` in `doc_col`.

    For each field: the value from the latest item that *contains* the key (an
    explicit null counts as contained), plus ``has_<field>`` = any item contained it.
    The presence flags are what make incremental merges equal to a full roll-up.
    """
    m = F.col(doc_col)
    order = _order(order_by)
    aggs = []
    for f in fields:
        present = F.map_contains_key(m, F.lit(f))
        aggs.append(F.max_by(m.getItem(f), F.when(present, order)).alias(f))
        aggs.append(F.bool_or(present).alias(has(f)))
    return df.groupBy(key).agg(*aggs, F.min(time_col).alias(INSERTED), F.max(time_col).alias(UPDATED))


def merge_fields(target: DataFrame, delta: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Merge two field-level roll-ups; a delta field overrides only where the delta had it."""
    cols = [*fields, *[has(f) for f in fields], INSERTED, UPDATED]
    j = _pair(target, delta, key, cols)
    out = [key]
    for f in fields:
        d_has = F.coalesce(F.col(f"d__{has(f)}"), F.lit(False))
        out.append(F.when(d_has, F.col(f"d__{f}")).otherwise(F.col(f"t__{f}")).alias(f))
    for f in fields:
        out.append((F.coalesce(F.col(f"t__{has(f)}"), F.lit(False)) | F.coalesce(F.col(f"d__{has(f)}"), F.lit(False))).alias(has(f)))
    in_d = F.coalesce(F.col("d__in"), F.lit(False))
    out.append(F.coalesce(F.col(f"t__{INSERTED}"), F.col(f"d__{INSERTED}")).alias(INSERTED))
    out.append(F.when(in_d, F.col(f"d__{UPDATED}")).otherwise(F.col(f"t__{UPDATED}")).alias(UPDATED))
    return j.select(*out)


def fold_batches(
    batches: Sequence[DataFrame],
    roll: Callable[[DataFrame], DataFrame],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint_every: int = 4,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Roll up each batch, then merge in batch order (onto `initial`, a stored roll-up).

    Every `checkpoint_every` merges the state is written with a reliable
    ``checkpoint()`` (into ``spark.checkpoint.dir``): the plan stops growing with the
    number of batches and a lost executor recomputes from the last checkpoint, not
    from the first batch.
    """
    state = initial
    for i, b in enumerate(batches):
        r = roll(b)
        state = r if state is None else combine(state, r)
        if checkpoint_every and i and i % checkpoint_every == 0:
            from docflow.session import shared_root

            shared_root(state.sparkSession)
            state = state.checkpoint(eager=True)
    if state is None:
        raise ValueError("no batches")
    return state


def apply_batches(
    batches: Sequence[DataFrame],
    key: str,
    doc_col: str,
    fields: Sequence[str],
    order_by: Sequence[str],
    time_col: str,
    checkpoint_every: int = 4,
) -> DataFrame:
    """Field-level roll-up of each batch, merged in batch order."""
    return fold_batches(
        batches,
        lambda b: roll_up_fields(b, key, doc_col, fields, order_by, time_col),
        lambda t, d: merge_fields(t, d, key, fields),
        checkpoint_every,
    )


def roll_up_open(
    df: DataFrame, key: str, doc_col: str, order_by: Sequence[str], time_col: str, out: str = "doc"
) -> DataFrame:
    """Field-level ``$set`` when the field names are open-ended: result is a ``map`` per key.

    One pass over the input: every present entry (explicit nulls included) becomes a
    row; (key, field) picks the latest value and the field's first/last times, which
    spreads even a hot key's work over its fields; the key then gathers one entry per
    distinct field (bounded by document width, not by the number of items) and the
    overall first/last times. ``explode_outer`` keeps items with empty documents for
    the times and, unlike ``explode``, lets no size filter be pushed below the decode.
    No session setting such as ``mapKeyDedupPolicy`` is needed.
    """
    order = _order(order_by)
    e = df.select(
        F.col(key), order.alias("__o"), F.col(time_col).alias("__t"),
        F.explode_outer(F.col(doc_col)).alias("__f", "__v"),
    )
    per_field = e.groupBy(key, "__f").agg(
        F.max_by("__v", "__o").alias("__v"), F.min("__t").alias("__t0"), F.max("__t").alias("__t1")
    )
    entry = F.when(F.col("__f").isNotNull(), F.struct("__f", "__v"))
    return per_field.groupBy(key).agg(
        F.map_from_entries(F.collect_list(entry)).alias(out),
        F.min("__t0").alias(INSERTED),
        F.max("__t1").alias(UPDATED),
    )


def merge_open(target: DataFrame, delta: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """Merge two open-field roll-ups: delta entries override, entries absent from it stay."""
    j = _pair(target, delta, key, [doc, INSERTED, UPDATED])
    t_doc = F.coalesce(F.col(f"t__{doc}"), F.create_map().cast("map<string,string>"))
    d_doc = F.coalesce(F.col(f"d__{doc}"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(t_doc, lambda k, v: ~F.map_contains_key(d_doc, k))
    in_d = F.coalesce(F.col("d__in"), F.lit(False))
    return j.select(
        key,
        F.map_concat(kept, d_doc).alias(doc),
        F.coalesce(F.col(f"t__{INSERTED}"), F.col(f"d__{INSERTED}")).alias(INSERTED),
        F.when(in_d, F.col(f"d__{UPDATED}")).otherwise(F.col(f"t__{UPDATED}")).alias(UPDATED),
    )
