"""Completeness of crawls against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.plans.completeness import crawl_gaps, page_log_writer, read_page_log
from docflow.session import scratch_path


def brute(rows, first=1):
    out = []
    for crawl in {c for c, _, _ in rows}:
        own = [(p, n) for c, p, n in rows if c == crawl]
        numbers = [p for p, _ in own if p is not None]
        named = [n for _, n in own if n is not None]
        if len(numbers) < len(own):
            out.append((crawl, "no_number", None, None, len(own) - len(numbers)))
        if not named:
            out.append((crawl, "no_end", min(numbers, default=None), max(numbers, default=None), None))
        for p in set(numbers):
            if numbers.count(p) > 1:
                out.append((crawl, "repeated", p, p, numbers.count(p)))
            if named and (p < first or p > max(named)):
                out.append((crawl, "surplus", p, p, numbers.count(p)))
            elif not named and p < first:
                out.append((crawl, "surplus", p, p, numbers.count(p)))
        missing = [p for p in range(first, max(named, default=first - 1) + 1) if p not in numbers]
        while missing:
            n = 1
            while n < len(missing) and missing[n] == missing[0] + n:
                n += 1
            out.append((crawl, "missing", missing[0], missing[n - 1], None))
            missing = missing[n:]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "crawl string, page long, last_page long")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


CASES = [
    ("complete", k, 3) for k in (1, 2, 3)
] + [
    ("ends", 2, 4), ("ends", 3, 4), ("one", 5, 9), ("all", None, 3), ("grown", 1, 2), ("grown", 2, 3), ("over", 1, 1), ("over", 2, 1), ("over", 0, 1), ("over", -4, None),
    ("blind", 4, None), ("blind", 4, None), ("twice", 1, 2), ("twice", 1, 2), ("twice", 2, 2), (None, 1, 3), (None, 3, 3), ("empty", 1, 0), ("bad", None, None), ("none", 7, -1),
]


def test_each_kind(spark):
    assert got(crawl_gaps(frame(spark, CASES))) == brute(CASES)
    assert ("complete", "missing") not in {r[:2] for r in got(crawl_gaps(frame(spark, CASES)))}
    assert got(crawl_gaps(frame(spark, []))) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_crawls(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "b", "c", None]), rng.choice([None, *range(-1, 30)]), rng.choice([None, 20, 25])) for _ in range(120)]
    assert got(crawl_gaps(frame(spark, rows).repartition(4), first=2)) == brute(rows, first=2)


def test_across_micro_batches_and_replays(spark):
    path = scratch_path(spark, "t_page_log")
    body = lambda n: '{"data":[],"meta":{"last_page":%d}}' % n
    write = page_log_writer(path)
    pages = lambda *rows: spark.createDataFrame([("c", *r) for r in rows], "crawl string, page int, body string")
    write(pages((1, body(5)), (2, "bad{")), 0)
    write(pages((4, body(5)), (2, body(5))), 1)
    write(pages((4, body(5)), (2, body(5))), 1)
    assert got(crawl_gaps(read_page_log(spark, path))) == [("c", "missing", 3, 3, None), ("c", "missing", 5, 5, None), ("c", "repeated", 2, 2, 2)]


def test_a_large_crawl_orders_only_the_ends_of_runs(spark):
    rows = spark.range(1, 20001).select(F.lit("hot").alias("crawl"), F.col("id").alias("page"), F.lit(20000).cast("long").alias("last_page"))
    gaps = crawl_gaps(rows.filter("page % 10000 <> 7"))
    assert sorted((r.kind, r.first_page, r.last_page) for r in gaps.collect()) == [("missing", 7, 7), ("missing", 10007, 10007)]
    plan = gaps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
