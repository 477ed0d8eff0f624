"""JDBC table sink (append / overwrite).

Spark opens one connection per partition; `num_partitions` caps concurrent
connections (coalesce, no shuffle) and `batchsize` sets rows per round trip.
Connection settings come from the caller; nothing is read from the environment.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_properties(user: str | None, password: str | None, driver: str | None = None) -> dict[str, str]:
    props: dict[str, str] = {}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    return props


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
    batchsize: int | None = None,
    truncate: bool = False,
) -> None:
    """Write `df` to `table`. ``mode="overwrite", truncate=True`` keeps the table's DDL."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    if num_partitions is not None:
        w = w.option("numPartitions", str(num_partitions))
    if batchsize is not None:
        w = w.option("batchsize", str(batchsize))
    if truncate:
        w = w.option("truncate", "true")
    w.save()
