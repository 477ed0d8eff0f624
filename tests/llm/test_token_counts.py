import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from docflow.llm.token_counts import UnigramCounter, count_tokens, vocabulary, words


def reference(pieces, unknown):
    t = Tokenizer(models.Unigram(pieces, unknown, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def public():
    return vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


EDGES = ["", " ", "  ", "a", " a  b   c ", "日本語\n\t", "<unk>a<0x41>", "\u0003\u0004x", "a▁b", "😀😀 x😀", "ção" * 9, "x" * 3000, "▁", "</s><s>", "a\n\n b"]


def test_equals_the_tokenizer(public):
    counter, want = UnigramCounter(public, 0), reference(public, 0)
    rng = random.Random(3)
    alphabet = "aeiou thn rs.,!0123éü\n▁\U0001f600中ก"
    texts = EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    assert [counter.count(t) for t in texts] == [want(t) for t in texts]


def test_ties_go_to_the_earliest_start_and_unknown_runs_are_one():
    pieces = [("?", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)]
    counter, want = UnigramCounter(pieces, 0), reference(pieces, 0)
    rng = random.Random(5)
    for _ in range(500):
        t = "".join(rng.choice("aabz ?") for _ in range(rng.randint(1, 14)))
        assert counter.count(t) == want(t), t


def test_words_partition_the_text():
    assert words("▁a▁▁b▁") == ["▁a", "▁▁b", "▁"]


def test_frame(documents, public):
    rows = [(1, None), (2, ""), (None, "hello world"), (3, "hello world"), (3, "hello world"), (4, "word " * 20000)]
    got = sorted(((r.doc_id, r.n_tokens) for r in count_tokens(documents(rows), public).collect()), key=str)
    want = reference(public, 0)
    assert got == sorted(((i, want(t) if t else 0) for i, t in rows), key=str)
    assert count_tokens(documents(rows).limit(0), public).count() == 0
