"""Keyed document store on files: versioned, bucketed by key, upserted by merge.

Each version is a Parquet directory `root/v=N_b=B_t=<writer>`, written bucketed (``bucketBy``)
into B buckets by the key and registered as an external table. Because the stored
side is already hash-partitioned by the key, merging a rolled-up delta into it is a
sort-merge join that shuffles only the delta. The bucket count is part of the
version's log entry, so a later session declares the table with the count it was
written with (a wrong count would silently mis-partition the join). A version is
current once its log entry is published (``docflow.sinks.store_log``): readers never see a half-written
version, a failed upsert can simply be run again, and of two writers of one version the second fails.
A version `v=N_b=B` without a log entry, as earlier releases wrote them, counts once it holds ``_SUCCESS``.
Older versions stay until ``docflow.sinks.retention`` removes them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from docflow.operators.upsert import merge, merge_fields
from docflow.sinks import store_log
from docflow.sinks.store_log import Entry

_VERSION = re.compile(r"^v=(\d+)_b=(\d+)$")
_LOGGED = re.compile(r"^v=\d+_b=\d+_t=[0-9a-f]+$")


def committed(spark: SparkSession, root: str) -> list[Entry]:
    """Committed versions under `root`, oldest first."""
    logged = store_log.entries(spark, root)
    known = {e.version for e in logged}
    fs, p, jvm = store_log.file_system(spark, root)
    old = []
    held = list(fs.listStatus(p)) if fs.exists(p) else []
    present = {st.getPath().getName() for st in held}
    if store_log.FOLDER not in present and any(_LOGGED.match(n) for n in present):
        raise RuntimeError(f"{root} holds versions, but their log {store_log.FOLDER} is missing (a copy without it?)")
    for st in held:
        m = _VERSION.match(st.getPath().getName())
        if st.isDirectory() and m and int(m[1]) not in known and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            old.append(Entry(int(m[1]), m[0], int(m[2])))
    return sorted([*old, *logged], key=lambda e: e.version)


def versions(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Committed (version, buckets) pairs under `root`, oldest first."""
    return [(e.version, e.buckets) for e in committed(spark, root)]


def _refuse_unmarked(spark: SparkSession, root: str) -> None:
    """Raise if a version folder holds data but no _SUCCESS marker (committer markers off, or a foreign copy):
    writing on would replace that data by the delta. A failed try leaves only _temporary and may be replaced."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(p) if fs.exists(p) else []:
        if st.isDirectory() and _VERSION.match(st.getPath().getName()):
            names = {f.getPath().getName() for f in fs.listStatus(st.getPath())}
            if "_SUCCESS" not in names and any(n.startswith("part-") for n in names):
                raise RuntimeError(f"{st.getPath()} holds data without _SUCCESS; the store needs the committer's success markers")


def _path(root: str, directory: str) -> str:
    return f"{root.rstrip('/')}/{directory}"


def _table(root: str, directory: str) -> str:
    return f"docflow_store_{hashlib.sha1(_path(root, directory).encode()).hexdigest()[:16]}"


def _register(spark: SparkSession, root: str, entry: Entry, key: str) -> str:
    """(Re)declare a version as an external bucketed table (metadata only, no data moves)."""
    name = _table(root, entry.directory)
    if not spark.catalog.tableExists(name):
        path = _path(root, entry.directory)
        schema = spark.read.parquet(path).schema
        cols = schema.toDDL()  # quotes nested names such as $date
        path = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {entry.buckets} BUCKETS LOCATION '{path}'"
        )
    return name


def read_keyed(spark: SparkSession, root: str, key: str, version: int | None = None) -> DataFrame | None:
    """Current (or the given) version as a bucketed table scan, or None when there is none."""
    found = [e for e in committed(spark, root) if version is None or e.version == version]
    return spark.table(_register(spark, root, found[-1], key)) if found else None


def _ordered(value: Column, kind: DataType) -> Column:
    """`value` in a form that can be compared: a map as its entries in order, at any depth."""
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(_ordered(e["key"], kind.keyType).alias("key"), _ordered(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda e: _ordered(e, kind.elementType))
    if isinstance(kind, StructType):
        parts = [_ordered(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def store_changes(spark: SparkSession, root: str, key: str, version: int | None = None) -> DataFrame:
    """Change events (operationType, fullDocument) that made a version, the current one by default.

    A key that the version before did not hold is an insert, another `updated_at` or any other
    difference of the document an update (several versions may share a time: pages of one crawl in
    several micro-batches). Both versions are bucketed by the key, so with equal bucket counts the
    join has no shuffle. A version whose predecessor was removed is an error: what changed is not known then.
    """
    vs = versions(spark, root)
    if not vs:
        raise ValueError(f"{root} holds no version")
    version = vs[-1][0] if version is None else version
    after = read_keyed(spark, root, key, version)
    if after is None:
        raise ValueError(f"{root} holds no version {version}")
    before = read_keyed(spark, root, key, version - 1)
    document = F.struct(*after.columns).alias("fullDocument")
    if before is None and version > 1:
        raise ValueError(f"version {version - 1} of {root} was removed: the changes of version {version} cannot be told")
    if before is None:
        return after.select(F.lit("insert").alias("operationType"), document)
    held = [f for f in before.schema.fields if f.name != key]
    known = before.select(key, F.struct(*[_ordered(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in held]).alias("__before"), F.lit(True).alias("__known"))
    joined = after.join(known, key, "left")
    inserted = F.col("__known").isNull()
    names = {f.name for f in held}
    same = F.lit(True)
    for f in after.schema.fields:
        if f.name != key:
            old = F.col("__before").getField(f.name) if f.name in names else F.lit(None)
            same = same & _ordered(F.col(f"`{f.name}`"), f.dataType).eqNullSafe(old)
    changed = joined.filter(inserted | ~same)
    return changed.select(F.when(inserted, F.lit("insert")).otherwise(F.lit("update")).alias("operationType"), document)


def write_version(
    spark: SparkSession, root: str, content: DataFrame, key: str, base: Entry | None, buckets: int, operation: str = "merge", transaction: tuple[str, int] | None = None
) -> int:
    """Write `content` as the version after `base` and publish it; ConcurrentWrite if another writer was first."""
    number = base.version + 1 if base else 1
    directory = f"v={number}_b={buckets}_t={uuid.uuid4().hex[:12]}"
    streams = dict(base.streams) if base else {}
    if transaction is not None:
        streams[transaction[0]] = int(transaction[1])
    name = _table(root, directory)
    store_log.prepare(spark, root)
    content.write.bucketBy(buckets, key).sortBy(key).option("path", _path(root, directory)).saveAsTable(name)
    try:
        store_log.publish(spark, root, Entry(number, directory, buckets, operation, streams))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: drops metadata only; retention removes the data
        raise
    return number


def is_replay(spark: SparkSession, root: str, transaction: tuple[str, int]) -> bool:
    """Whether the store already holds this batch of this stream, or a later one."""
    held = committed(spark, root)
    return bool(held) and held[-1].streams.get(transaction[0], -1) >= int(transaction[1])


def upsert_keyed(
    spark: SparkSession,
    root: str,
    delta: DataFrame,
    key: str,
    fields: Sequence[str],
    buckets: int | None = None,
    presence: bool = False,
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    transaction: tuple[str, int] | None = None,
) -> int:
    """Merge a rolled-up `delta` (``roll_up`` / ``roll_up_fields`` output) into the store.

    Writes the next version and returns its number. `buckets`: None keeps the store's
    count (a new store takes ``spark.sql.shuffle.partitions``, so the delta's shuffle
    already matches); a different count re-buckets, which shuffles the stored side once.
    `presence` selects field-level ``$set`` merging, `combine` any other merge of (current, delta).
    `transaction`, (stream id, batch id), is written with the version. A batch that the store holds already is
    skipped, and the current version's number returned. Of two upserts at once the second raises ConcurrentWrite.
    """
    _refuse_unmarked(spark, root)
    held = committed(spark, root)
    base = held[-1] if held else None
    if base and transaction is not None and base.streams.get(transaction[0], -1) >= int(transaction[1]):
        return base.version
    if buckets is None:
        buckets = base.buckets if base else int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = read_keyed(spark, root, key, base.version) if base else None
    if current is None:
        merged = delta
    elif combine is not None:
        merged = combine(current, delta)
    else:
        merged = (merge_fields if presence else merge)(current, delta, key, fields)
    return write_version(spark, root, merged, key, base, buckets, transaction=transaction)
