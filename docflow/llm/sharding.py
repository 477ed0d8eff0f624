"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of a fixed number of slots (thousands). One aggregate gives
the bytes of each slot, so what the driver sees has one row for each slot, whatever the
corpus holds. The map from slots to shards is a small table with versions: version 1 deals
slots out in turn, and a rebalance writes the next version, in which only the slots that had
to move have changed. Records never carry a shard; they get it by a join with the map.

A slot is the unit that moves, so equal rows (one id, one text) must not fill one: where a slot holds more than
a small part of a shard, each copy of a row that repeats in bulk there is dealt to a slot of its own, by its
row number. Copies then spread over all slots, and so over shards and tasks. Equal texts
under different ids hash apart anyway.

Defined results: a null text has size 16 and the crc of no bytes; null ids are hashed like any
value; rows that repeat count every time; an empty table gives an empty result; ties (equal rows) take
their places in any order; columns beyond doc_id and text are ignored, whatever their names. Native DataFrame
code throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192
#: A slot may hold this part of a shard before rows that repeat in it are dealt out.
SHARE = 64
ROW_BYTES = 16
MAP_SCHEMA = "version int, slot int, shard int"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row; the text itself goes no further."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")
    return sized.withColumn("virtual_slot", slot)


def spread_copies(recs: DataFrame, sizes: list, shards: int, slots: int = SLOTS) -> DataFrame | None:
    """``recs`` with the copies of bulky rows in slots of their own, or None if no slot is crowded.

    ``sizes``: rows of ``slot_sizes``; ``recs`` holds a ``row_id``. A crowded slot has more than 1/SHARE of a shard's
    bytes, so there are at most SHARE * shards; a bulky row half of that in its copies, so there are at most twice as many:
    both sets may be broadcast. The copies are counted by an aggregate that combines before the shuffle.
    """
    limit = sum(r["bytes"] for r in sizes) / (SHARE * shards)
    crowded = [(r["virtual_slot"],) for r in sizes if r["bytes"] > limit and r["rows"] > 1]
    if not crowded:
        return None
    in_crowd = recs.join(F.broadcast(recs.sparkSession.createDataFrame(crowded, "virtual_slot int")), "virtual_slot")
    counted = in_crowd.groupBy("virtual_slot", "doc_id", "text_crc32").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    bulky = counted.filter((F.col("bytes") > limit / 2) & (F.col("rows") > 1)).select(F.col("virtual_slot").alias("of_slot"), F.col("doc_id").alias("of_id"), F.col("text_crc32").alias("of_crc"), F.lit(True).alias("bulky"))
    same = (F.col("virtual_slot") == F.col("of_slot")) & F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_crc32") == F.col("of_crc"))
    own = F.pmod(F.xxhash64("doc_id", "text_crc32", "row_id"), F.lit(slots)).cast("int")
    marked = recs.join(F.broadcast(bulky), same, "left")
    return marked.withColumn("virtual_slot", F.when(F.col("bulky"), own).otherwise(F.col("virtual_slot"))).select(*recs.columns)


def slot_sizes(recs: DataFrame) -> DataFrame:
    """Bytes and rows of every slot that has rows (at most one row for each slot)."""
    return recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 1: slots dealt out in turn."""
    return [slot % shards for slot in range(slots)]


def rebalance(shard_of: list[int], weight: list[int], shards: int) -> list[int]:
    """Next version of a map: move single slots, or exchange two, from the fullest to the emptiest shard while the gap closes.

    Shards beyond the old number start empty and shards taken away hand all their slots on.
    Slots that need not move stay where they are.
    """
    out = list(shard_of)
    load = [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(out):
        if shard < shards:
            members[shard].add(slot)
            load[shard] += weight[slot]
        else:
            homeless.append(slot)

    def move(slot: int, to: int) -> None:
        if out[slot] < shards:
            members[out[slot]].discard(slot)
            load[out[slot]] -= weight[slot]
        out[slot] = to
        members[to].add(slot)
        load[to] += weight[slot]

    for slot in sorted(homeless, key=lambda s: (-weight[s], s)):
        move(slot, min(range(shards), key=lambda x: (load[x], x)))
    while True:  # every step brings two shards nearer to each other, so there is a last one
        high = max(range(shards), key=lambda x: (load[x], -x))
        low = min(range(shards), key=lambda x: (load[x], x))
        gap = load[high] - load[low]
        if gap <= 1:
            break
        slot = min(members[high], key=lambda s: (abs(2 * weight[s] - gap), s), default=None)
        gain = gap - abs(gap - 2 * weight[slot]) if slot is not None and 0 < weight[slot] < gap else 0
        swap = _best_exchange(members[high], members[low], weight, gap) if gain < gap else None
        if swap is not None and gap - abs(gap - 2 * (weight[swap[0]] - weight[swap[1]])) > gain:
            move(swap[0], low)
            move(swap[1], high)
        elif gain > 0:
            move(slot, low)
        else:
            break
    return out


def _best_exchange(high: set[int], low: set[int], weight: list[int], gap: int) -> tuple[int, int] | None:
    """The pair whose difference is nearest to half the gap (two sorted lists, one walk)."""
    a = sorted(high, key=lambda s: (weight[s], s))
    b = sorted(low, key=lambda s: (weight[s], s))
    best, found, j = gap, None, 0
    for x in a:
        while j < len(b) and 2 * (weight[x] - weight[b[j]]) > gap:
            j += 1
        for y in b[max(0, j - 1) : j + 1]:
            d = weight[x] - weight[y]
            if 0 < d < gap and abs(2 * d - gap) < best:
                best, found = abs(2 * d - gap), (x, y)
    return found


def write_map(spark: SparkSession, root: str, version: int, shard_of: list[int]) -> None:
    """Store one version of the map in its own folder; versions are never changed once written."""
    rows = [(version, slot, shard) for slot, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{root}/version={version:06d}")


def read_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{root}/version={version:06d}")


def place(recs: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Shard of every record and its place in the shard, gapless from 0.

    A place is the rows of the shard's lower slots plus the place inside the slot, so no task
    sorts a whole shard. The map and the sizes have at most one row for each slot.
    """
    rows = F.coalesce(F.col("rows"), F.lit(0))
    below = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = slot_map.select(F.col("slot").alias("virtual_slot"), "shard").join(sizes.select("virtual_slot", "rows"), "virtual_slot", "left")
    bases = bases.select("virtual_slot", "shard", F.coalesce(F.sum(rows).over(below), F.lit(0)).alias("base"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = recs.withColumn("place", F.row_number().over(inside).cast("long") - F.lit(1))
    return numbered.join(F.broadcast(bases), "virtual_slot").withColumn("slot", F.col("base") + F.col("place"))


def shard_documents(docs: DataFrame, root: str, shards: int, slots: int = SLOTS) -> DataFrame:
    """Balance bytes over ``shards``: slots, their bytes, map versions 1 and 2 under ``root``, and every row's place."""
    from docflow.llm.common import on_cluster_disk

    spark = docs.sparkSession
    # numbered once, on shared disk: a copy has the same number in every pass and after a lost executor
    recs = on_cluster_disk(records(docs, slots).withColumn("row_id", F.monotonically_increasing_id()))
    rows = slot_sizes(recs).collect()  # one row for each slot at most
    dealt = spread_copies(recs, rows, shards, slots)
    if dealt is not None:
        recs = dealt
        rows = slot_sizes(recs).collect()
    recs = recs.drop("row_id")
    weight = [0] * slots
    for r in rows:
        weight[r["virtual_slot"]] = r["bytes"]
    version1 = first_map(shards, slots)
    write_map(spark, root, 1, version1)
    write_map(spark, root, 2, rebalance(version1, weight, shards))
    counted = spark.createDataFrame([(r["virtual_slot"], r["rows"]) for r in rows], "virtual_slot int, rows long")
    return place(recs, read_map(spark, root, 2), counted)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 under the law `bytes`."""
    from docflow.llm.common import read_documents
    from docflow.session import scratch_path

    placed = shard_documents(read_documents(spark, sf_dir), scratch_path(spark, "slot_map"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
