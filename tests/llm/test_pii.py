import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from docflow.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    """Base spans straight from their definition."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def noise(n=400):
    rng = random.Random(9)
    bits = ["a@b.co", "x@", ".com", "a.b", "@", "_d", "1.2.3.4", "999.1.1.1", "0255.001.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (132) 555-1352", "+49 30 1", " ", "\n", "é", "😀", "12", "-", "+", ".", "(974) 555-3436", "ssn 123-45-6789", "me [at] site [dot] org", "8", "é@é.com"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(n)]


EDGES = [None, "", "a@b.c_d@e.f", "x@y@z.com", "1.2.3.4.5", "0.0.0.0 256.1.1.1", "9" * 13, "é😀 a@b.de", "+" * 50, "1 2-3 4 5 6 7 8 9 0 1 2 3 4", "a" * 20000 + "@b.c", "1-" * 20000, "mail me at a@b.com. " * 300]


@pytest.fixture(scope="module")
def spans(spark):
    rows = [(i, t, "s") for i, t in enumerate(EDGES + noise())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.candidates(docs.drop("spans")).cache()
    weights = pii.train(found)
    out = found.withColumn("s", pii.accepted(weights))
    base = F.filter("s", lambda c: c["base"])
    return rows, out.select("doc_id", pii.written(base).alias("base"), pii.written(F.col("s")).alias("all"), pii.redacted(F.col("text"), F.col("s")).alias("clean")).collect()


def test_base_spans_follow_the_definition(spans):
    rows, got = spans
    got = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        assert got[i].base == ",".join(brute(text)), text
        assert not got[i].base or set(got[i].base.split(",")) <= set(got[i].all.split(","))


def replaced(text, spans):
    """The text with every run of overlapping spans replaced by the name of its first kind, in plain Python."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out.append(text[at:start] + f"[{kind.upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_replaces_every_span(spans):
    rows, got = spans
    order = {k: n for n, k in enumerate(pii.KINDS)}
    for r in got:
        text = rows[r.doc_id][1]
        found = [s.split(":") for s in r.all.split(",")] if r.all else []
        assert {f"{k}:{a}:{b}" for k, a, b in found} >= set(brute(text))
        assert r.clean == (replaced(text, sorted(((int(a), int(b), k) for k, a, b in found), key=lambda s: (s[0], s[1], order[s[2]]))) if found else text)


def test_method_adds_other_kinds(spark):
    rows = [(1, "call me: (974) 555-3436 now", "local_phone", "(974) 555-3436"), (2, "my ssn is 123-45-6789.", "national_id", "123-45-6789"), (3, "mail me [at] site [dot] org, please", "obfuscated_email", "me [at] site [dot] org")]
    found = pii.candidates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    got = {r.doc_id: r.s for r in found.withColumn("s", pii.written(pii.accepted(pii.train(found)))).collect()}
    assert got == {i: f"{kind}:{text.index(part)}:{text.index(part) + len(part)}" for i, text, kind, part in rows}


def test_em_finds_the_unreliable_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        true = rng.random() < 0.6
        said = lambda right: int(true) if rng.random() < right else int(not true)
        votes = (said(0.95), said(0.9), None if rng.random() < 0.5 else said(0.9), said(0.55))
        counts[0, votes] = counts.get((0, votes), 0) + 1
    rows = [(k, v, n) for (k, v), n in counts.items()]
    post = pii.reliabilities(rows)
    assert post[0, (1, 1, 1, 0)] > 0.95 and post[0, (0, 0, 0, 1)] < 0.05
    weights = pii.span_classifier(rows, post)
    assert weights[len(pii.KINDS) + 1] > weights[len(pii.KINDS)]


def test_empty_table_and_columns(spark, documents):
    docs = documents([(1, "a@b.com"), (None, None), (1, "a@b.com")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, ""), (1, "[EMAIL]"), (1, "[EMAIL]")]
    assert pii.redact(docs.limit(0)).count() == 0


def test_digest(spark):
    assert spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0] == hashlib.sha256(b"").hexdigest()


def test_places_and_redaction_of_very_many_matches(spark):
    """100,000 matches in one text, in pieces of every kind, take seconds."""
    part = "é\U0001f600 mail a.b@c.org, host 10.1.2.3; " * 3 + "x" * 700 + " "
    text = part * 17000
    found = pii.candidates(spark.createDataFrame([(1, text), (2, part), (3, "")], "doc_id long, text string"))
    weights = pii.train(found)
    began = time.time()
    rows = found.select("doc_id", pii.written(pii.accepted(weights)).alias("s"), pii.redacted(F.col("text"), pii.accepted(weights)).alias("clean")).collect()
    assert time.time() - began < 60
    got = {r.doc_id: r for r in rows}
    own = [(kind, int(a), int(b)) for kind, a, b in (x.split(":") for x in brute(part))]
    for i, t, n in ((1, text, 17000), (2, part, 1)):
        spans = [f"{kind}:{a + k * len(part)}:{b + k * len(part)}" for name in ("email", "ip") for k in range(n) for kind, a, b in own if kind == name]
        assert got[i].s == ",".join(spans) and len(spans) == 6 * n
        assert got[i].clean == t.replace("a.b@c.org", "[EMAIL]").replace("10.1.2.3", "[IP]")
    assert got[3].clean == ""
