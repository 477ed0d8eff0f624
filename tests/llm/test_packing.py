import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import packing
from docflow.llm.flatwords import WordTable, text_parts

CAP = np.array([100.0, 5.0, 100.0**2])
W = np.array([1.0, 0.01, 0.01])


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(packing.tokenizer_file())


def encode(words, texts):
    ids, edges = words.encode(pa.array(texts, pa.string()))
    return [ids[lo:hi].astype("<u4").tobytes() for lo, hi in zip(edges[:-1], edges[1:])]


def whole(words, text):
    return np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


TEXTS = ["", " ", "it's they'll DON'T 's a's. x!!'s", "ÀÈ.. ß: ﬁ ½ 1st a0b 0 0.0 <|endoftext|> a<|startoftext|>b  x y\tz\x1cq\x85w İI ΑΣ. é a̸", "0 0 a 0", "#.#a, a#b# $$$&&& _x_ é_.", "x" * 5000, "日本語 テキスト", "a\n\nb"]


def test_words_give_the_ids_of_whole_texts(words):
    assert encode(words, TEXTS) == [whole(words, t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbé'sßIİ ΣΤ0.,!#\n\t́<|>中", max_size=40))
def test_any_text(words, text):
    assert encode(words, [text]) == [whole(words, text)]


def test_a_small_cache_changes_nothing(words, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    own = packing.WordIds(packing.tokenizer_file())
    for _ in range(2):
        assert encode(own, TEXTS) == [whole(own, t) for t in TEXTS]


def test_a_full_table_keeps_frequent_words(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    own = packing.WordIds(packing.tokenizer_file())
    for k in range(30):
        texts = [f"Always here, often. new{k}x{j} word{chr(97 + k % 26)}{chr(97 + j)}" for j in range(12)]
        assert encode(own, texts) == [whole(own, t) for t in texts]
        assert len(own.number) == own.ids.lists <= 60 + 60
        if k > 3:
            assert {"Always", "here,", "often."} <= set(own.number)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(0)
    size = rng.integers(1, 90, 600).astype(float)
    need = np.column_stack([size, np.ones(600), size * size])
    bins = packing.best_fit(need, CAP, W, rule)
    for b in range(bins.max() + 1):
        assert (need[bins == b].sum(axis=0) <= CAP + 1e-9).all() and (bins == b).any()
    assert bins.max() + 1 <= 1.15 * max((need.sum(axis=0) / CAP).max(), 1)


def test_best_fit_edges():
    assert len(packing.best_fit(np.empty((0, 3)), CAP, W)) == 0
    assert packing.best_fit(np.array([[60.0, 1, 3600], [40, 1, 1600], [60, 1, 3600], [40, 1, 1600]]), CAP, W).max() == 1
    with pytest.raises(ValueError):
        packing.best_fit(np.array([[101.0, 1, 1]]), CAP, W)


def test_pack(documents, words):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (None, "a b c"), (4, "same text"), (5, "same text"), (5, "same text")] + [(10 + i, "one two three " * (i * 7)) for i in range(60)]
    cut = packing.pieces(documents(rows), packing.tokenizer_file(), keep_ids=True)
    got = packing.pack(cut).collect()
    want = defaultdict(list)
    for i, t in rows:
        ids = whole(words, t or "") + b"\1\0\0\0"
        for k, lo in enumerate(range(0, len(ids), 4 * 4096)):
            own = ids[lo : lo + 4 * 4096]
            want[i].append((k, lo // 4, len(own) // 4, zlib.crc32(own), own))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 4096) + 1
    assert packing.pack(packing.pieces(documents(rows).limit(0), packing.tokenizer_file())).count() == 0


def plan(got):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append(r.length)
    return list(by.values())


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [{}, {"max_documents": 3}, {"max_attention": 3 * 500**2}, {"max_documents": 4, "max_attention": 2 * 700**2}])
def test_each_capacity_binds(spark, caps, rule):
    """Every piece is placed once, every capacity holds, and the number of sequences is near the bound of the scarcest one."""
    rng = np.random.default_rng(5)
    length = [int(n) for n in np.r_[rng.integers(1, 40, 300), rng.integers(300, 700, 300)]]
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(length)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    bins = plan(packing.pack(cut, rule=rule, **caps).collect())
    limit = {"max_tokens": 4096, "max_documents": 4096, "max_attention": 4096**2} | caps
    assert sorted(n for b in bins for n in b) == sorted(length)
    assert all(sum(b) <= limit["max_tokens"] and len(b) <= limit["max_documents"] and sum(n * n for n in b) <= limit["max_attention"] for b in bins)
    bound = max(sum(length) / limit["max_tokens"], len(length) / limit["max_documents"], sum(n * n for n in length) / limit["max_attention"])
    free = plan(packing.pack(cut, rule=rule).collect())
    assert len(bins) <= 1.2 * bound + 1 and (not caps or len(bins) > len(free))


def test_registered_query_needs_hardly_more_than_the_bound(spark):
    sf = "/root/testdata/sf0.01"
    got = packing.op8_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokenizer = packing.WordIds(packing.tokenizer_file()).tokenizer
    for r in got:
        if r.doc_id % 9 == 0:
            ids = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1], dtype="<u4")[r.start : r.start + r.length]
            assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
    assert {r.doc_id for r in got} == set(texts)
    assert len(plan(got)) <= 1.001 * -(-sum(r.length for r in got) // 4096)


RUNS = st.text(alphabet="aZ09.,-_é Éß×÷ÿĀđİıĸŁ'<|>\n\ṯ中", max_size=30)


@settings(max_examples=100, deadline=None)
@given(st.lists(RUNS, max_size=8))
def test_texts_beside_each_other(words, texts):
    """Case, letters of two bytes and borders of words, also where one text ends and the next begins without a blank."""
    assert encode(words, texts) == [whole(words, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=20), min_size=1, max_size=30), max_size=4), st.integers(0, 12))
def test_a_word_table_confuses_no_words(parts, most):
    """Words of any bytes and sizes, zeros and equal ends among them, are found again exactly; a forgotten one is unknown."""
    table, known = WordTable(np.uint32), {}

    def find(words):
        size = np.array([len(w) for w in words], dtype=np.int64)
        return np.frombuffer(b"".join(words) + bytes(8), dtype=np.uint8), np.cumsum(size) - size, size

    for part in parts:
        part = [*part, *(w[:-1] + b"\0" for w in part), *(w + b"\0" for w in part), *(w[:8] + w[-8:] for w in part)]
        found = table.find(*find(part))
        assert [n >= 0 for n in found] == [w in known for w in part]
        new = [w for w in dict.fromkeys(part) if w not in known]
        sizes = np.array([len(w) % 4 for w in new], dtype=np.int64)
        table.add(*find(new), np.repeat(np.array([len(w) for w in new], dtype=np.uint32), sizes), sizes)
        known |= {w: None for w in new}
        found = table.find(*find(part))
        assert [table.words()[n] for n in found] == part
        ids, sizes = table.ids.gather(found)
        assert ids.tolist() == [len(w) for w in part for _ in range(len(w) % 4)] and sizes.tolist() == [len(w) % 4 for w in part]
        table.used(found)
        if len(table) > most:
            table.forget(most, 4 * most)
            known = dict.fromkeys(table.words())
            assert len(known) == len(table) <= most


def test_a_worker_stays_small():
    """More new words than a worker remembers, in parts as large as ``pieces`` makes them: 65 MB at most, 125 MB before."""
    own = packing.WordIds(packing.tokenizer_file())
    letters = np.random.default_rng(3).integers(97, 123, (400_000, 7), dtype=np.uint8)
    texts = pa.array([" ".join(bytes(r).decode() for r in letters[at : at + 1000]) for at in range(0, len(letters), 1000)])
    tracemalloc.start()
    try:
        for row, stop in text_parts(texts, packing.PART_BYTES):
            own.encode(texts.slice(row, stop - row))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most <= 80 << 20
    assert len(own.number) == own.ids.lists <= packing.REMEMBERED
