"""Language by string kernel: the kernel and the solution against plain Python, held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm import language as la

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    signs = " " + "".join(chr(b).lower() if chr(b).isascii() and chr(b).isalpha() else (chr(b) if b >= 128 else " ") for b in (text or "").encode()) + " "
    return {signs[i : i + n] for n in range(1, la.ORDER + 1) for i in range(len(signs) - n + 1)} - {" " * n for n in range(1, la.ORDER + 1)}


TEXTS = ["the cat", "THE CAT sat on the mat, the end.", "", "x", "12 ,.", "été à la mer", "日本", "the cat", None, "ab" * 5000, " a "]


def test_grams_and_kernel_against_plain_sets():
    column = pa.array(TEXTS)
    sets = list(la.Grams().of(column))
    want = [plain_grams(t) for t in TEXTS]
    assert [len(s) for s in sets] == [len(w) for w in want]
    marks = [0, 1, 5, 9, 2]
    order = sorted(marks, key=lambda k: (len(sets[k]), np.sort(sets[k]).tolist()))
    kernel = la.Kernel(la.Landmarks.of([sets[k] for k in order]))
    kernel.rows = 3
    got = np.concatenate(list(kernel.of(column)))
    for i, a in enumerate(want):
        for j, k in enumerate(order):
            share = len(a & want[k]) / max(np.sqrt(len(a) * len(want[k])), 1.0)
            assert got[i, j] == pytest.approx(share, abs=1e-12)


def test_ridge_solution_is_the_minimum():
    rng = np.random.default_rng(0)
    k, y = rng.random((30, 5)), rng.random((30, 2))
    m = np.eye(5) + 0.3
    a = la.ridge_solution(k, m, y, 0.5)

    def cost(w):
        return np.square(k @ w - y).sum() + 0.5 * np.trace(w.T @ m @ w)

    for _ in range(20):
        assert cost(a) <= cost(a + 1e-3 * rng.standard_normal(a.shape))


def test_held_out_accuracy_on_whole_table(spark):
    got = {r.doc_id: r for r in la.op12_language(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r for r in docs.select("doc_id", "lang", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("out")).collect()}
    assert set(got) == set(truth) and all(got[i].held_out == truth[i].out and 0 <= got[i].score <= 1 for i in got)
    out = [i for i in got if got[i].held_out]
    assert len(out) > 250 and sum(got[i].lang_pred == truth[i].lang for i in out) >= 0.99 * len(out)


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_odd_rows(spark):
    rows = [(k, "the cat sat on the mat and the dog", "en") for k in range(40)] + [(50 + k, f"der hund und die katze {'sehr ' * k}", "de") for k in range(20)]
    rows += [(90, "un gato y el perro", "es"), (91, None, "es"), (92, "", "en"), (93, "12 34", "de"), (94, "gato " * 60000, None), (None, "the dog", None), (1, "the cat sat on the mat and the dog", "en"), (95, "日本語", None), (96, "ß", None)]
    docs = labelled(spark, rows)
    model = la.learn(docs)
    assert model.languages == ["de", "en", "es"]
    got = {}
    for r in la.classify(docs, model, ["doc_id"]).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert sum(map(len, got.values())) == len(rows) and len(got[1]) == 2 and len(set(got[1])) == 1
    assert got[91] == got[92] == got[93] == [("und", 0.0)]
    assert got[94][0][0] == "es" and got[None][0][0] == "en" and got[55][0][0] == "de" and got[0][0][0] == "en"
    assert got[95] == [("de", 0.0)]
    assert la.classify(docs.limit(0), model, ["doc_id"]).count() == 0


def test_nothing_to_learn(spark):
    docs = labelled(spark, [(1, "some text", None), (2, None, "en"), (3, "...", "en")])
    model = la.learn(docs)
    assert model.languages == [] and {(r.lang_pred, r.score) for r in la.classify(docs, model, ["doc_id"]).collect()} == {("und", 0.0)}


def test_every_language_gets_its_turn_in_the_sample(spark):
    rows = [(k, f"common text number {k} {'ab' * (k % 7)}", "big") for k in range(200)] + [(300 + k, f"klein {k}", f"s{k}") for k in range(5)]
    got = la.training_sample(labelled(spark, rows).select("text", "lang"), sample=20).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"big": 15} | {f"s{k}": 1 for k in range(5)}
