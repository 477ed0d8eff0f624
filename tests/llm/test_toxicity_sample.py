"""The training sample is bounded by rows, however often a sampled id repeats."""

from docflow.llm import toxicity


def learned(spark, documents, monkeypatch, rows, labelled):
    seen = {}
    select, train = toxicity.select_features, toxicity.train

    def sizes(counts, positives, unlabelled):
        seen["sizes"] = (positives, unlabelled)
        return select(counts, positives, unlabelled)

    def count(rows, *rest):
        seen["rows"] = (sum(p for p, _ in rows), sum(not p for p, _ in rows))
        return train(rows, *rest)

    monkeypatch.setattr(toxicity, "select_features", sizes)
    monkeypatch.setattr(toxicity, "train", count)
    labels = spark.createDataFrame([(i, int(i < 10)) for i in labelled], "doc_id long, toxic int")
    model = toxicity.learn(documents(rows), labels, held_out=99, max_pos=6, max_unl=20)
    return seen, model


def test_a_repeated_id_is_one_training_row(spark, documents, monkeypatch):
    once = [(i, f"bad awful w{i}" if i < 10 else f"good fine w{i}") for i in range(40)]
    copies = [(i, t if k % 2 else None) for i, t in once for k in range(30)]
    own, first = learned(spark, documents, monkeypatch, once, range(40))
    got, second = learned(spark, documents, monkeypatch, copies, range(40))
    assert own["rows"] == got["rows"] == got["sizes"] == (6, 20)
    assert first.features.tolist() == second.features.tolist() and abs(first.bias - second.bias) < 1e-9


def test_sizes_are_of_rows_that_exist(spark, documents, monkeypatch):
    got, _ = learned(spark, documents, monkeypatch, [(i, f"bad w{i}") for i in range(0, 40, 2)], range(40))
    assert got["rows"] == got["sizes"] and got["rows"][0] > 0 and got["rows"][1] < 20
