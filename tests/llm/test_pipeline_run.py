"""The whole pipeline on a small corpus, every written stage against plain Python; crowded regions with small blocks."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from docflow.llm import neardup, packing

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture
def small_blocks(monkeypatch):
    """Small bounds, and what the crowded paths made: rounds of election, families, guests, pairs of blocks."""
    seen = defaultdict(list)
    for name, value in (("CROWD", 8), ("BLOCK", 5), ("SET_BLOCK", 4)):
        monkeypatch.setattr(neardup, name, value)
    regions, families, across, within, guests = neardup.regions, neardup.families, neardup.across_families, neardup.within_families, neardup.with_guests

    def noted(name, real):
        def call(*args):
            out = real(*args)
            seen[name].append(out)
            return out

        monkeypatch.setattr(neardup, real.__name__, call)

    for name, real in (("regions", regions), ("families", families), ("guests", across), ("within", within), ("visits", guests)):
        noted(name, real)
    return seen


def slide(rng, words, first, texts, step=3, width=120):
    """Near copies in a chain: neighbours are alike, the ends are not."""
    return [(first + k, " ".join(words[step * k : step * k + width])) for k in rng.sample(range(texts), texts)]


def shingles(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for at, (i, a) in enumerate(sets):
        for j, b in sets[:at]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: root(i) for i in label}


def test_crowds_families_and_guests(documents, small_blocks):
    rng = random.Random(3)
    rows = slide(rng, [f"a{i}" for i in range(400)], 0, 70) + slide(rng, [f"b{i}" for i in range(400)], 1000, 30)
    base = [f"c{i}" for i in range(150)]
    rows += [(2000 + k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])) for k in range(40)]
    rows += [(3000 + k, " ".join(f"own{k}x{i}" for i in range(30))) for k in range(20)]
    want = components(rows)
    got = neardup.near_duplicates(documents(rows), width=5, percent=80).collect()
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == {i: (c, c == i) for i, c in want.items()}
    [regions], [families], [guests], [within], [visits] = (small_blocks[k] for k in ("regions", "families", "guests", "within", "visits"))
    assert regions.filter(f"size > {neardup.CROWD} and size > {neardup.BLOCK}").take(1)  # elections in rounds
    assert families.select("family").distinct().count() > 2 and guests.take(1) and visits.filter("j > 0").take(1)
    assert within.filter("i < j").take(1)


def without_windows(text, windows):
    places = list(ALNUM.finditer(text.lower()))
    words = [m.group() for m in places]
    hit = np.zeros(len(words) + 1, dtype=bool)
    for j in range(len(words)):
        for n in {len(w) for w in windows}:
            if tuple(words[j : j + n]) in windows and j + n <= len(words):
                hit[j : j + n] = True
    out, at = "", 0
    for k, m in enumerate(places):
        if hit[k] and (k == 0 or not hit[k - 1]):
            out += text[at : m.start()]
        if hit[k] and not hit[k + 1]:
            at = m.end()
    return out + text[at:], bool(words) and hit[:-1].all()


def test_run_against_plain_python(spark, small_blocks, monkeypatch, tmp_path):
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(3000)]
    fresh = lambda n: " ".join(rng.sample(plain, n))
    clean = [(i, fresh(60)) for i in range(60)]
    toxic = [(100 + i, " ".join([fresh(20), "hateful vile scum", fresh(20), "filthy vermin"])) for i in range(40)]
    passage = " ".join(f"bench{i}" for i in range(14))
    leaks = [(200 + i, f"{fresh(20)}. {passage}; {fresh(20)}") for i in range(5)] + [(210, passage)]
    private = [(300 + i, f"{fresh(20)} write to name{i}@example.org about {fresh(20)}") for i in range(30)]
    crowd = slide(rng, [f"d{i}" for i in range(300)], 400, 50)
    copies = [(500 + i, clean[0][1]) for i in range(3)] + [(5, clean[5][1])]
    rows = clean + toxic + leaks + private + crowd + copies + [(600, ""), (601, None), (None, fresh(30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labelled = sorted({i for i, _ in rows if i is not None})
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i in labelled], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, "no such passage")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    paths, real = {}, corpus_pipeline.scratch_path

    def noted(spark, name):
        return paths.setdefault(name, real(spark, name))

    monkeypatch.setattr(corpus_pipeline, "scratch_path", noted)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert list(paths) == [f"stage_{name}" for name, _ in corpus_pipeline.STAGES]

    def held(name):
        return Counter((r.doc_id, r.text) for r in spark.read.parquet(paths[f"stage_{name}"]).collect())

    left = [(i, t) for i, t in rows if i is None or not 100 <= i < 200]
    assert held("toxicity") == Counter(left)
    keyed = {i: t for i, t in left if i is not None}
    kept = [(i, keyed[i]) for i, c in components(list(keyed.items())).items() if c == i] + [r for r in left if r[0] is None]
    assert held("near_duplicates") == Counter(kept)
    words = passage.split()
    windows = {tuple(words[j : j + 10]) for j in range(5)} | {("no", "such", "passage")}
    cut = [(i, t, *without_windows(t or "", windows)) for i, t in kept]
    cut = [(i, None if t is None else new) for i, t, new, whole in cut if not whole]
    assert held("decontamination") == Counter(cut) and 210 not in dict(cut)
    redacted = [(i, t and re.sub(r"name\d+@example\.org", "[EMAIL]", t)) for i, t in cut]
    assert held("personal_data") == Counter(redacted)
    tokens = packing.WordIds(packing.tokenizer_file()).tokenizer
    end = np.array([packing.END_ID], dtype="<u4").tobytes()
    ids = [(i, np.array(tokens.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() + end) for i, t in redacted]
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in packed) == Counter((i, len(x) // 4, zlib.crc32(x)) for i, x in ids)
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= packing.MAX_TOKENS
