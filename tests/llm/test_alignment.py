"""Alignment of two tokenizers against whole-text tokenising and plain Python grouping."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import alignment as al


@pytest.fixture(scope="module")
def units():
    return al.Units(*al.tokenizer_files())


def plain(units, text):
    """(A ids, B ids, groups) of a whole text, or None where the bytes differ."""
    if not text:
        return None
    raw = (" " + text).encode()
    ids = [units.a.ids(" " + text), units.b.ids(" " + text)]
    if any(b"".join(t.bytes[i] for i in x) != raw for t, x in zip((units.a, units.b), ids)):
        return None
    ends = [set(np.cumsum([len(t.bytes[i]) for i in x]).tolist()) for t, x in zip((units.a, units.b), ids)]
    cuts = sorted(ends[0] & ends[1])
    groups, at = [], [0, 0]
    done = [0, 0]
    for cut in cuts:
        group = []
        for k, t in enumerate((units.a, units.b)):
            lo = at[k]
            while done[k] < cut:
                done[k] += len(t.bytes[ids[k][at[k]]])
                at[k] += 1
            group.append(ids[k][lo : at[k]])
        groups.append(group)
    return *ids, groups


def brute(units, rows):
    every = [plain(units, t) for _, t in rows]
    count = Counter(p for x in every if x for p in {(a, b) for ga, gb in x[2] for a in ga for b in gb})
    top = defaultdict(int)
    for (a, _), c in count.items():
        top[a] = max(top[a], c)
    out = []
    for (i, _), x in zip(rows, every):
        if not x:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a, b) for ga, gb in x[2] for a in ga for b in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in x[2])
        out.append((i, len(x[0]), len(x[1]), len(x[2]), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\nb", "a\n\nb", "a\n\n\nb\n", "\na", "a\t b\t\tc \t d", "x  y  z", "one two\nthree  four\r\n five\n",
    "▁ piece", "mixed ▁", "café naïve über straße", "日本語 テキスト \U0001f600\U0001f468‍\U0001f469 end", "<|endoftext|> <s> </s><unk> <0x41>", "it's they'll DON'T",
    "é ​ zero​width 　 wide", "tab\x0b\x0c\x1c\x85 x", "nul \x00 byte", "12345 3.14159 $$$ !!! ...", "aaaa" * 400, "word " * 3000 + "end", "İI Σς", "same text here", "same text here", "same text here",
]


def test_rows_against_plain_python(spark, documents, units):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(7, "repeated id"), (None, "no id")]
    want = brute(units, rows)
    assert got(al.align_tokenizers(documents(rows).repartition(3), *al.tokenizer_files())) == want
    assert got(al.align_tokenizers(documents(rows), *al.tokenizer_files(), block_bytes=64)) == want
    assert al.align_tokenizers(documents(rows).limit(0), *al.tokenizer_files()).count() == 0


def test_a_small_memory_changes_nothing(units, monkeypatch):
    monkeypatch.setattr(al, "REMEMBERED", 4)
    monkeypatch.setattr(al, "LESSON_BYTES", 16)
    monkeypatch.setattr(al, "LINKS_AT_ONCE", 8)
    own = al.Units(*al.tokenizer_files())
    texts = [t or "" for t in TEXTS]
    for lo in range(0, len(texts), 5):
        part = texts[lo : lo + 5]
        block = al.align_block(pa.array(part), own)
        for k, row in enumerate(block.rows.tolist()):
            x = plain(units, part[row])
            assert block.counts[k].tolist() == ([len(x[0]), len(x[1]), len(x[2]), sum(len(a) * len(b) for a, b in x[2])] if x else [0] * 4), part[row]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbé'sß.,! \n\n\t\r ▁　中́<|>\x0009", max_size=30), min_size=1, max_size=3))
def test_any_text(units, texts):
    block = al.align_block(pa.array(texts), units)
    for k, row in enumerate(block.rows.tolist()):
        x = plain(units, texts[row])
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in x[2]) if x else None
        assert block.groups[k] == (hashlib.sha256(text.encode()).hexdigest() if x else "")


def test_groups_expand_over_overlaps():
    group_a, group_b = al.coalesce(np.array([3, 5, 9, 12]), np.array([2, 5, 7, 12]), np.array([0, 3, 5, 9]), np.array([0, 2, 5, 7]))
    assert group_a.tolist() == [0, 0, 1, 1] and group_b.tolist() == [0, 0, 1, 1]


def test_registered_query_on_the_small_tables(spark, units):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = al.op13_tokenizer_alignment(spark, sf)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(df) == brute(units, rows)
