"""Commit log of a keyed store: one small JSON file for each version, created only where it is absent.

A writer writes its data into a directory of its own and then publishes the next log entry. Of two
writers that started from the same version one publishes; the other fails, and its data is
never seen. Publishing writes a temporary file and moves it to the entry's name without replacing: a
hard link on a local or mounted folder, a rename that refuses an existing target on HDFS. A store on
another file system needs one of the two.

An entry also carries, for each stream that ever wrote, its last batch. A replayed micro-batch is
recognised by it.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_log"
_ENTRY = re.compile(r"^(\d{8,})\.json$")


class ConcurrentWrite(RuntimeError):
    """Another writer published the version first; nothing of this write is visible."""


@dataclass(frozen=True)
class Entry:
    version: int
    directory: str
    buckets: int
    operation: str = "merge"
    streams: dict[str, int] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object, jvm) of a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, p, _ = file_system(spark, path)
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (none if it does not exist)."""
    fs, p, _ = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def entries(spark: SparkSession, root: str) -> list[Entry]:
    """Published versions, oldest first."""
    folder = f"{root.rstrip('/')}/{FOLDER}"
    return sorted((Entry(**json.loads(read_text(spark, f"{folder}/{n}"))) for n in names(spark, folder) if _ENTRY.match(n)), key=lambda e: e.version)


def prepare(spark: SparkSession, root: str) -> None:
    """Create the log's folder before the first data: versions without it are a store whose log was lost."""
    fs, p, _ = file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    fs.mkdirs(p)


def entry_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:08d}.json"


def publish(spark: SparkSession, root: str, entry: Entry) -> None:
    """Make a version visible; ConcurrentWrite if that version is published already."""
    target = entry_path(root, entry.version)
    temporary = f"{root.rstrip('/')}/{FOLDER}/.{entry.version:08d}.{uuid.uuid4().hex[:12]}.tmp"
    write_text(spark, temporary, json.dumps(asdict(entry), sort_keys=True))
    fs, source, jvm = file_system(spark, temporary)
    goal = jvm.org.apache.hadoop.fs.Path(target)
    try:
        if fs.getScheme() == "file":
            os.link(source.toUri().getPath(), goal.toUri().getPath())
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(goal.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, goal, options)
    except FileExistsError as taken:
        raise ConcurrentWrite(f"version {entry.version} of {root} was published by another writer") from taken
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" in str(failed.java_exception):
            raise ConcurrentWrite(f"version {entry.version} of {root} was published by another writer") from failed
        raise
    finally:
        fs.delete(source, False)
