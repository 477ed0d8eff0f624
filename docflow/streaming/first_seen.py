"""The first sight of each document in a stream of pages, by keyed state.

The state of a key says that it was seen; it is held by RocksDB, partitioned by the key, and checkpointed with the
stream, so a restarted stream emits nothing twice. Within a micro-batch each task first keeps the earliest row of
a key it has (a hot key ships one row for each Arrow batch, not all its rows); then keys meet in groups of many keys,
and the earliest row of each reaches Spark's streaming deduplication, which holds the state. No Python call or state
request of its own is made for a single key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Groups of keys for each shuffle partition: a group holds the candidates of a micro-batch divided by all groups.
GROUPS_PER_PARTITION = 4


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Streams started in this session from now on hold their state in RocksDB."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB)


def first_seen(items: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The rows of a stream whose `key` was never seen before: of each key the first by `order_by` in its first micro-batch.

    Rows without a key are left out (``page_items`` puts them in the quarantine). Append mode.
    """
    order = [key, *order_by]

    def earliest(batch):
        return batch.sort_values(order, na_position="last", kind="stable").drop_duplicates(key)

    def earliest_of_each(batches: Iterator) -> Iterator:
        yield from map(earliest, batches)

    candidates = items.filter(F.col(key).isNotNull()).mapInPandas(earliest_of_each, items.schema)
    partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS_PER_PARTITION * partitions))
    return candidates.groupBy(group).applyInPandas(earliest, items.schema).dropDuplicates([key])
