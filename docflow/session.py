"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "docflow") -> SparkSession:
    """Session used by tests and the bench; on a cluster use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset and the master is local (tests)
    do we pick a folder of our own; on a cluster an unset value is an error,
    because a machine-local folder is not visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server owns the setting
        sc = None
    root = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        root = tempfile.mkdtemp(prefix="docflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run's outputs."""
    return f"{shared_root(spark)}/docflow/{name}-{uuid.uuid4().hex[:12]}"
