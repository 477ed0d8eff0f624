"""Hard negatives against plain Python over all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm import hardnegatives as hn


def brute(rows, is_anchor, scale=256.0, low_percent=80, size=5):
    usable = {}
    for i, label, vector in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None), key=lambda r: (r[0], r[1], str(r[2]))):
        if all(x is not None and math.isfinite(x) for x in vector):
            usable.setdefault(i, (label, [math.floor(scale * x) for x in vector]))
    out = []
    for a, (label, q) in usable.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, own) for i, (own, p) in usable.items() if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:size]:
            band = [x for x in scored if x[2] != label and low_percent * -s <= 100 * -x[0] <= 100 * -s][:size]
            out += [(a, i, rank, j, -s, -n) for rank, (n, j, _) in enumerate(band, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, score string, anchor int")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(seed, n, width, spread=0.4):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((4, width))
    near = rng.integers(0, 4, n)
    x = np.round(centre[near] + spread * rng.standard_normal((n, width)), 2)
    return [(k, int(rng.integers(0, 3)) if k % 5 == 0 else int(near[k]), x[k].tolist()) for k in range(n)]


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_against_all_pairs(spark, block):
    rows = clustered(1, 300, 8)
    df = frame(spark, rows).repartition(4)
    assert got(hn.hard_negatives(df, F.col("vec_id") % 10 == 0, block=block)) == brute(rows, lambda i: i % 10 == 0)


def test_ties_copies_and_odd_rows(spark):
    rows = clustered(2, 60, 4, spread=0.0)  # a third and more of the rows are equal vectors: every rank is decided by ties
    rows += [(0, 9, [1.0] * 4), (100, 0, None), (110, None, [1.0] * 4), (120, 0, [1.0, None, 0.0, 0.0]), (130, 0, [float("nan")] * 4), (140, 0, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, 0, [1.0] * 4), (150, 0, []), (151, 0, [2.0]), (160, 1, [0.0] * 4), (161, 1, [0.0] * 4), (170, 7, [3.0] * 9), rows[5], rows[5]]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and got(hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block=3)) == want
    assert hn.hard_negatives(frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_scores_beyond_double_precision_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(k, k % 2, (rng.integers(-(1 << 20), 1 << 20, 4) * 2.0 + 1 / 256).tolist()) for k in range(40)]
    assert got(hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0)) == brute(rows, lambda i: i % 5 == 0)


def test_bounds_hold_and_spare_scores():
    rows = clustered(4, 400, 16, spread=0.05)
    x = hn.whole_numbers(pa.array([r[2] for r in rows]), 256.0)
    tree = hn.Tree(np.arange(0, 400, 10), np.array([r[1] for r in rows[::10]]), x[::10])
    assert sorted(k for own in tree.children for k in own) == list(range(1, 40))
    scored = 0

    def wanted(k, low, high):
        true = x @ tree.q[k]
        assert (low <= true).all() and (true <= high).all()
        return np.flatnonzero(high >= 0.9 * true.max())

    for _, pick, score in tree.walk(x, hn.norms(x), wanted):
        scored += len(pick)
    assert scored < 0.5 * 40 * 400
