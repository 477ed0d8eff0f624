"""Sorted orders, common prefixes and adaptive depth of the near-duplicate forest; recall against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from docflow.llm import neardup


def place(*values):
    return np.array(values, dtype=">u4").tobytes()


def brute(rows):
    """(tree, nodes) of every region: runs of a common prefix, one minhash deeper in crowds."""
    out = []
    by = defaultdict(list)
    for node, orders in rows:
        for tree, p in enumerate(orders):
            by[tree, p[: 4 * neardup.SHALLOW]].append((node, p))
    for (tree, _), run in by.items():
        if len(run) <= neardup.CROWD:
            out.append((tree, tuple(sorted(n for n, _ in run))))
            continue
        deep = defaultdict(list)
        for n, p in run:
            deep[p].append(n)
        out += [(tree, tuple(sorted(d))) for d in deep.values()]
    return Counter(r for r in out if len(r[1]) > 1)


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_regions_are_the_runs_of_the_orders(spark, monkeypatch, partitions):
    monkeypatch.setattr(neardup, "CROWD", 6)
    rng = random.Random(3)
    rows = [(n, [place(rng.randint(0, 3), rng.randint(0, 30 if t else 3), rng.randint(0, 2)) for t in range(3)]) for n in range(300)]
    rows += [(1000 + n, [place(9, 9, 9)] * 3) for n in range(60)]  # a crowd of one place, in several tasks
    df = spark.createDataFrame([(n, [bytearray(p) for p in o]) for n, o in rows], "node long, orders array<binary>")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = defaultdict(list)
        for r in neardup.regions(df).collect():
            got[r.tree, r.region, r["size"]].append(r.node)
        alone = neardup.forest(df).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(len(n) == size for (_, _, size), n in got.items())
    assert Counter((t, tuple(sorted(n))) for (t, _, _), n in got.items()) == brute(rows)
    assert alone < 3 * 360  # rows without a near neighbour leave in the sorted pass


def test_common_prefix():
    p = np.array([[1, 2, 3], [1, 2, 4], [1, 9, 4], [1, 9, 4], [1, 9, 4]], dtype=">u4")
    assert neardup.common_prefix(np.array([0, 0, 0, 0, 1]), p).tolist() == [0, 2, 1, 3, 0]


def test_recall_against_all_pairs(spark, documents):
    """Hundreds of edited copies around the threshold: every component of the exact links is found."""
    rng = random.Random(8)
    rows, sets = [], []
    for base in range(60):
        words = [f"w{base}_{k}" for k in range(120)]
        for copy in range(6):
            own = list(words)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    links = [(i, j) for i in range(len(rows)) for j in range(i) if i // 6 == j // 6 and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = list(range(len(rows)))
    for _ in range(20):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(rows), width=4, percent=80).collect()}
    together = sum(got[i] == got[j] for i, j in links)
    assert len(links) > 200 and together >= 0.99 * len(links)
    assert all(got[i] == root[i] for i in got) or together < len(links)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 32, 33, 70])
def test_typical_member(n):
    sketch = np.random.default_rng(n).integers(0, 4, (n, neardup.SLOTS), dtype=np.uint8)
    agree = [sum(int((sketch[i] == sketch[j]).sum()) for j in range(n)) for i in range(n)]
    assert neardup._typical(sketch) == agree.index(max(agree))
