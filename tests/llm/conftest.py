import pytest


@pytest.fixture
def documents(spark):
    """A small documents table from (doc_id, text) rows, with columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), "x", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, slot string, score int")

    return make
