"""File sinks: JSON lines, per-batch idempotent directories, versioned Parquet store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "batch_id"

# JSON text keeps timestamps to the microsecond (Spark's default JSON format stops at
# milliseconds). Use the same options when reading the files back.
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_jsonl(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite `path` with JSON lines (UTF-8 kept, one part file per partition).

    `single_file` coalesces to one partition; only for small outputs.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**JSON_TIME_OPTIONS).json(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent micro-batch write: replace exactly the folder `batch_id=N`.

    A replay of batch N (after a failure before the stream's commit) leaves one copy; a replay
    that is empty now leaves no row of the first try.
    """
    df.drop(BATCH_COL).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{BATCH_COL}={int(batch_id)}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions `v=N` under `root` whose write committed (``_SUCCESS`` present)."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def read_store(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """Latest committed version of a versioned store, or None when empty."""
    vs = committed_versions(spark, root)
    if not vs:
        return None
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/v={vs[-1]}")


def write_store(spark: SparkSession, df: DataFrame, root: str, fmt: str = "parquet") -> int:
    """Write `df` as the next version; readers switch only once its ``_SUCCESS`` exists.

    Writing a new directory (never over the one being read) makes the swap atomic
    for readers and lets a failed write be retried: it never committed.
    """
    vs = committed_versions(spark, root)
    nxt = (vs[-1] + 1) if vs else 1
    df.write.mode("overwrite").format(fmt).save(f"{root.rstrip('/')}/v={nxt}")
    return nxt


def preview(df: DataFrame, n: int = 20, truncate: bool = True, enabled: bool = False) -> None:
    """Print the first rows. Off unless `enabled`: each call is an extra Spark job."""
    if enabled:
        df.show(n, truncate=truncate)
