"""Shard sizes when a third of all rows are one row."""

import zlib
from collections import Counter, defaultdict

import pytest

from docflow.llm import sharding


def shards(spark, documents, rows, n, root):
    got = sharding.shard_documents(documents(rows).repartition(3), str(root), n).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows)
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [size[k] for k in range(n)], got


@pytest.mark.parametrize("copy", [(7, "the same text again"), (None, None), (3, "x" * 400)])
def test_identical_rows_spread_over_all_shards(spark, documents, tmp_path, copy):
    rows = [copy] * 700 + [(1000 + i, "word " * (i % 50)) for i in range(1300)]
    size, got = shards(spark, documents, rows, 8, tmp_path / "map")
    largest = max(len((t or "").encode()) + 16 for _, t in rows)
    assert max(size) - min(size) <= largest
    assert len({r.shard for r in got if r.doc_id == copy[0]}) == 8


def test_few_rows_with_many_copies(spark, documents, tmp_path):
    size, _ = shards(spark, documents, [(1, "a")] * 60 + [(i, "b") for i in range(2, 142)], 40, tmp_path / "map")
    assert max(size) - min(size) <= 17


def test_distinct_rows_keep_their_hashed_slots(spark, documents, tmp_path):
    rows = [(i, f"text {i}") for i in range(3000)]
    recs = sharding.records(documents(rows))
    want = {r.doc_id: r.virtual_slot for r in recs.collect()}
    _, got = shards(spark, documents, rows, 4, tmp_path / "map")
    assert {r.doc_id: r.virtual_slot for r in got} == want


def test_rebalance_ends_with_nothing_left_to_gain():
    weight = [(k * 7919) % 101 for k in range(500)]
    out = sharding.rebalance(sharding.first_map(6, 500), weight, 6)
    load = [sum(w for w, s in zip(weight, out) if s == k) for k in range(6)]
    assert max(load) - min(load) <= 1
