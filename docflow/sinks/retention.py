"""Upkeep of a keyed store: removing versions that nobody needs, and compacting buckets of several files.

A consumer of the store's changes keeps the version it has reached in `root/_cursors`. To tell the
changes of the next version it needs that version itself, so nothing at or after the lowest
cursor goes, nor the newest `keep` versions. A removed version first loses its log entry, then its data; what a broken
removal or a losing writer left behind has no entry and goes at the next time.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from docflow.sinks import store_log
from docflow.sinks.keyed_store import committed, read_keyed, write_version

CURSORS = "_cursors"
AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
_DIRECTORY = re.compile(r"^v=(\d+)_b=(\d+)(_t=[0-9a-f]+)$")


def cursor_path(root: str, consumer: str) -> str:
    return f"{root.rstrip('/')}/{CURSORS}/{quote(consumer, safe='')}.json"


def cursors(spark: SparkSession, root: str) -> dict[str, int]:
    """Version that each consumer has reached."""
    folder = f"{root.rstrip('/')}/{CURSORS}"
    return {unquote(n.removesuffix(".json")): json.loads(store_log.read_text(spark, f"{folder}/{n}"))["version"] for n in store_log.names(spark, folder) if n.endswith(".json") and not n.startswith(".")}


def remove_consumer(spark: SparkSession, root: str, consumer: str) -> None:
    """A consumer that is gone no longer holds versions back."""
    fs, p, _ = store_log.file_system(spark, cursor_path(root, consumer))
    fs.delete(p, False)


def retain(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Remove the versions that no consumer needs, but the newest `keep`; returns their numbers."""
    if keep < 1:
        raise ValueError("a store keeps its current version")
    held = committed(spark, root)
    if not held:
        return []
    newest = held[-1].version
    needed = min([newest - keep + 1, *cursors(spark, root).values()])
    root = root.rstrip("/")
    removed = [e for e in held if e.version < needed]
    for entry in removed:
        fs, p, jvm = store_log.file_system(spark, store_log.entry_path(root, entry.version))
        fs.delete(p, False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{entry.directory}"), True)
    alive = {e.directory for e in held} - {e.directory for e in removed}
    for name in store_log.names(spark, root):
        m = _DIRECTORY.match(name)
        # a directory of the next version may belong to a writer that is at work
        if m and name not in alive and int(m[1]) <= newest:
            fs, p, _ = store_log.file_system(spark, f"{root}/{name}")
            fs.delete(p, True)
    return [e.version for e in removed]


def bucket_files(spark: SparkSession, root: str) -> Counter:
    """Files of each bucket of the current version."""
    held = committed(spark, root)
    found = (re.search(r"_(\d+)(?:\.c\d+)?\.[^/]*$", n) for n in store_log.names(spark, f"{root.rstrip('/')}/{held[-1].directory}") if n.startswith("part-")) if held else ()
    return Counter(int(m[1]) for m in found if m)


def compact(spark: SparkSession, root: str, key: str) -> int:
    """Rewrite the current version with one sorted file a bucket, as a version without changes; returns the current version's number.

    A task reads the files of one bucket and writes one, so no row is shuffled. Nothing is written if every bucket has one file.
    """
    held = committed(spark, root)
    if not held:
        raise ValueError(f"{root} holds no version")
    current = held[-1]
    if max(bucket_files(spark, root).values(), default=1) <= 1:
        return current.version
    # the planner otherwise reads a bucketed table file by file when nothing above the scan asks for the buckets
    before = spark.conf.get(AUTO_SCAN)
    spark.conf.set(AUTO_SCAN, "false")
    try:
        rows = read_keyed(spark, root, key, current.version)
        return write_version(spark, root, rows, key, current, current.buckets, operation="compact")
    finally:
        spark.conf.set(AUTO_SCAN, before)
