"""Driver contract: entry runs, every query has an oracle, oracles match at sf0.001."""

import pytest

import __spark_entry__ as E
from __spark_entry__ import QUERIES
from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "id" and len(df.columns) == 11
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, cur.fetchall())[0]
