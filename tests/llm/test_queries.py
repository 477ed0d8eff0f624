import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from docflow.llm.queries import ORACLE, QUERIES
from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    df = QUERIES[key](spark, SF)
    cur = duck(SF).execute(ORACLE[key])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, cur.fetchall())[0]


def test_stages_keep_columns_and_act(spark):
    """Copies, a benchmark passage and an address planted among the documents are gone; a clean one is untouched."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = " ".join(f"plain{i} words{i}" for i in range(40))
    planted = [(10**6, clean), (10**6 + 1, clean), (10**6 + 2, "Before it. " + passage + " after that " + clean[:200]), (10**6 + 3, "Write to someone@example.org about " + clean[200:500])]
    rows = spark.createDataFrame(planted, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = source.unionByName(rows).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == source.columns, name
    got = {r.doc_id: r for r in docs.filter("doc_id >= 1000000").collect()}
    assert set(got) == {10**6, 10**6 + 2, 10**6 + 3}
    assert got[10**6].text == clean and passage not in got[10**6 + 2].text and "someone@" not in got[10**6 + 3].text
    assert all(r.n_chars == len(r.text) for r in got.values())
