"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Candidates are the matches of one pattern for each kind. Four labelers vote yes, no or nothing on
each: shape (checksums and value ranges), gazetteer (known domains, issuers, calling codes,
reserved ranges), context (words in front of the span) and border (what the span touches). The
corpus is summed to counts of (kind, votes) patterns, at most 81 for each kind, so all candidates
count and the driver sees a table of fixed size. On it, expectation-maximisation estimates for
each kind the share of true spans and each labeler's reliability, and a logistic span classifier
is fitted to the posteriors. Its weights go back into a column expression.

The base kinds (email, ip, card, phone) are kept wherever their shape holds. The other kinds are
kept where the classifier says so. Places are code points; a pattern's matches and the text
between them give the places. Patterns are written so that no text makes them backtrack.

Native: DataFrame functions only, and no shuffle but that of the pattern counts.

Defined results: a null or empty text has no spans; repeated rows and ids are treated each; an
empty table gives no rows; other columns are passed over, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import on_cluster_disk, read_documents

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("obfuscated_email", "local_phone", "national_id")
KINDS = BASE_KINDS + EXTRA_KINDS
LABELERS = ("shape", "gazetteer", "context", "border")
CONTEXT = 32  # characters in front of a span that a labeler reads
ACCEPT = 0.5

_LOCAL = "A-Za-z0-9._%+-"
# A match starts where a run of its first characters starts, or right behind the match before (\G).
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "obfuscated_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}\x20?[\[(]dot[\])]\x20?[A-Za-z]{2,24}",
    "local_phone": r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[\x20.-]{0,2})(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must hold before the pattern is tried.
NEEDS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "obfuscated_email": r"[\[(]at[\])]", "local_phone": r"[0-9]{3}[\x20.-][0-9]{4}", "national_id": r"[0-9]-[0-9]{2}-[0-9]",
}

# What the gazetteer and context labelers know.
_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|ch|at|us|ca"
_KNOWN = {
    "email": rf"(?i)\.(?:{_DOMAINS})$",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "obfuscated_email": rf"(?i)(?:{_DOMAINS})$",
}
_UNLIKELY = {
    "email": r"(?i)@(?:localhost|[^@]*\.(?:invalid|test|local|png|jpg|js|py))$",
    "ip": r"^(?:0|127|22[4-9]|2[3-5][0-9])\.",
    "card": r"^0",
    "local_phone": r"^\(?[01]",
    "national_id": r"^(?:000|666|9)|-00-|-0000$",
}
_BEFORE = {
    "email": r"mail|contact|write to|reach", "ip": r"\bip\b|host|server|address|login|from", "card": r"card|visa|master|credit|debit|payment",
    "phone": r"phone|tel|call|mobile|fax|contact", "obfuscated_email": r"mail|contact|write to|reach", "local_phone": r"phone|tel|call|mobile|fax|contact",
    "national_id": r"ssn|social|security|tax|national",
}
_AGAINST = {
    "ip": r"version|release|section|chapter", "card": r"isbn|order|invoice|serial|tracking", "phone": r"order|serial", "local_phone": r"order|serial|isbn|part",
    "national_id": r"order|serial|isbn|part",
}


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check digit of a string of at most 19 digits."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(n - i + F.lit(1), F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _shape(kind: str, word: Column) -> Column:
    """Does the match hold what its kind demands beyond the pattern."""
    if kind == "ip":
        part = F.split(word, r"\.")
        value = F.transform(part, lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(value, lambda v: (F.length(v) <= 3) & (F.coalesce(F.when(F.length(v) <= 3, v).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(word))
        return F.when(n.between(13, 19), _luhn(_digits(word))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(word)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, 0).when(yes, 1)


def _votes(kind: str, c: Column) -> list[Column]:
    """Votes of the labelers on a candidate, 1, 0 or null."""
    word, before, after = c["word"], F.lower(c["before"]), c["after"]
    rlike = lambda text, table: text.rlike(table[kind]) if kind in table else F.lit(False)
    plain = _digits(word) if kind == "card" else word
    if kind == "email":
        shape = _vote(word.rlike(r"\.[A-Za-z]{2,24}$"), ~word.rlike(r"[A-Za-z]$") | word.rlike(r"^[.%+-]|\.\."))
    else:
        shape = _vote(_shape(kind, word), ~_shape(kind, word))
    glued = before.rlike(r"[A-Za-z0-9_]$") | after.rlike(r"^[A-Za-z0-9_]")
    return [
        shape.cast("int"),
        _vote(rlike(plain, _KNOWN), rlike(plain, _UNLIKELY)).cast("int"),
        _vote(rlike(before, _BEFORE), rlike(before, _AGAINST)).cast("int"),
        _vote(~glued, glued).cast("int"),
    ]


_FOUND = "array<struct<start:int,end:int,word:string,before:string,after:string>>"
#: Code points of a piece of a long text.
PIECE = 1024


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array, its predecessors joined (``zero`` for the first).

    In blocks of about the cube root of the length: the totals of the blocks before, then those in the same
    block, so n elements take n**(4/3) steps, not n**2.
    """

    def blocks(v: Column) -> Column:
        return _once(F.ceil(F.cbrt(F.size(v) * F.lit(2.0))).cast("int"), lambda b: in_blocks(v, b))

    def in_blocks(v: Column, b: Column) -> Column:
        number = F.sequence(F.lit(0), F.ceil(F.size(v) / b).cast("int") - 1)
        totals = F.transform(number, lambda k: F.aggregate(F.slice(v, k * b + 1, b), zero, join))
        return _once(totals, lambda t: _once(F.transform(t, lambda _, k: F.aggregate(F.slice(t, F.lit(1), k), zero, join)), lambda base: single(v, b, base)))

    def single(v: Column, b: Column, base: Column) -> Column:
        at = lambda i: F.floor(i / b).cast("int")
        return F.transform(v, lambda _, i: F.aggregate(F.slice(v, at(i) * b + 1, i % b), F.get(base, at(i)), join))

    return _once(values, lambda v: F.when(F.size(v) > 0, blocks(v)).otherwise(v))


def _found(words: Column, gaps: Column) -> Column:
    """Places and surroundings of matches, from the matches and the text between them."""
    steps = F.transform(words, lambda w, i: F.length(F.get(gaps, i)) + F.length(w))

    def place(at: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            gap = F.get(gaps, i)
            start = F.get(at, i) + F.length(gap)
            return F.struct(start.alias("start"), (start + F.length(word)).alias("end"), word.alias("word"), F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))

        return F.transform(words, one)

    places = _once(_before(steps, F.lit(0), lambda x, y: x + y), place)
    return F.when(F.size(words) > 0, places).otherwise(F.array().cast(_FOUND))


def candidates(docs: DataFrame, out: str = "pii_candidates") -> DataFrame:
    """The input with an array of candidates (kind, start, end, base, votes of the labelers) in column ``out``."""
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    word, gap, place = ({k: f"__{what}_{k}" for k in KINDS} for what in ("words", "gaps", "places"))
    none = F.array().cast("array<string>")
    df = docs.select("*", *[F.when(text.rlike(NEEDS[k]), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(word[k]) for k in KINDS])
    df = df.select(*names, *word.values(), *[F.when(F.size(word[k]) > 0, F.split(text, PATTERNS[k], -1)).alias(gap[k]) for k in KINDS])
    df = df.select(*names, *[_found(F.col(word[k]), F.col(gap[k])).alias(place[k]) for k in KINDS])

    def judge(kind: str) -> Column:
        def one(c: Column) -> Column:
            base = _shape(kind, c["word"]) if kind in BASE_KINDS else F.lit(False)
            votes = [v.alias(n) for n, v in zip(LABELERS, _votes(kind, c))]
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), base.alias("base"), *votes)

        return F.transform(F.col(place[kind]), one)

    return df.select(*names, F.concat(*[judge(k) for k in KINDS]).alias(out))


def pattern_counts(found: DataFrame, column: str = "pii_candidates") -> list[tuple[int, tuple, int]]:
    """(kind, votes, number) of every pattern of votes: 81 for each kind at most."""
    # the filter that an inner explode infers would find all matches again, and again for each match
    one = found.select(F.explode_outer(column).alias("c")).filter(F.col("c").isNotNull())
    rows = one.groupBy("c.kind", *[f"c.{n}" for n in LABELERS]).agg(F.count("*").alias("n")).orderBy("kind", *LABELERS).collect()
    return [(r["kind"], tuple(r[n] for n in LABELERS), r["n"]) for r in rows]


def reliabilities(counts: list[tuple[int, tuple, int]], rounds: int = 100) -> dict[tuple[int, tuple], float]:
    """Posterior of every (kind, votes) pattern, by expectation-maximisation for each kind.

    A labeler has two reliabilities, its yes rate on true spans and its no rate on false ones; both start,
    and are held by a small prior, on the right side of chance. Abstentions say nothing.
    """
    out = {}
    for kind in sorted({k for k, _, _ in counts}):
        own = [(v, n) for k, v, n in counts if k == kind]
        share, yes, no = 0.5, [0.8] * len(LABELERS), [0.8] * len(LABELERS)
        post: dict[tuple, float] = {}
        for _ in range(rounds):
            for votes, _n in own:
                log_odds = math.log(share / (1 - share))
                for j, v in enumerate(votes):
                    if v == 1:
                        log_odds += math.log(yes[j] / (1 - no[j]))
                    elif v == 0:
                        log_odds += math.log((1 - yes[j]) / no[j])
                post[votes] = 1 / (1 + math.exp(-max(-40.0, min(40.0, log_odds))))
            total = sum(n for _, n in own)
            share = (sum(post[v] * n for v, n in own) + 5.0) / (total + 10.0)
            for j in range(len(LABELERS)):
                said = [(v[j], post[v], n) for v, n in own if v[j] is not None]
                true = sum(p * n for _, p, n in said)
                false = sum((1 - p) * n for _, p, n in said)
                yes[j] = (sum(p * n for s, p, n in said if s == 1) + 8.0) / (true + 10.0)
                no[j] = (sum((1 - p) * n for s, p, n in said if s == 0) + 8.0) / (false + 10.0)
        out |= {(kind, v): p for v, p in post.items()}
    return out


def _features(kind: int, votes: tuple) -> list[int]:
    """Numbers of the features that are on: kind, and for each labeler yes or no."""
    return [kind, *(len(KINDS) + 2 * j + v for j, v in enumerate(votes) if v is not None)]


def span_classifier(counts: list[tuple[int, tuple, int]], posterior: dict[tuple[int, tuple], float], rounds: int = 500, decay: float = 1e-3) -> list[float]:
    """Logistic weights (kinds first, then no and yes of every labeler) fitted to the posteriors, by gradient steps."""
    weights = [0.0] * (len(KINDS) + 2 * len(LABELERS))
    rows = [(_features(k, v), posterior[k, v], math.log1p(n)) for k, v, n in counts]  # a frequent pattern does not drown a rare one
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(rounds):
        grad = [decay * w for w in weights]
        for on, p, n in rows:
            z = sum(weights[f] for f in on)
            miss = (1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) - p) * n / total
            for f in on:
                grad[f] += miss
        weights = [w - 2.0 * g for w, g in zip(weights, grad)]
    return weights


def train(found: DataFrame, column: str = "pii_candidates") -> list[float]:
    counts = pattern_counts(found, column)
    return span_classifier(counts, reliabilities(counts))


def accepted(weights: list[float], column: str = "pii_candidates") -> Column:
    """The candidates that are spans: every base match, and others by the classifier; by kind, then start."""
    kinds = F.array(*[F.lit(float(w)) for w in weights[: len(KINDS)]])

    def keep(c: Column) -> Column:
        z = F.get(kinds, c["kind"])
        for j, name in enumerate(LABELERS):
            no, yes = weights[len(KINDS) + 2 * j : len(KINDS) + 2 * j + 2]
            z = z + F.when(c[name] == 1, F.lit(float(yes))).when(c[name] == 0, F.lit(float(no))).otherwise(F.lit(0.0))
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return c["base"] | ((c["kind"] >= len(BASE_KINDS)) & (score >= ACCEPT))

    return F.array_sort(F.filter(column, keep))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive) of a text in pieces of ``PIECE`` of them; never counts from the text's begin."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    inside = F.substring(F.get(pieces, first), start % PIECE + 1, end - start)
    across = F.concat(
        F.substring(F.get(pieces, first), start % PIECE + 1, F.lit(PIECE)),
        F.array_join(F.slice(pieces, first + 2, last - first - 1), ""),
        F.substring(F.get(pieces, last), F.lit(1), end - last * PIECE),
    )
    return F.when(end <= start, F.lit("")).when(first == last, inside).otherwise(across)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of spans that overlap, replaced by the name of its first kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    placed = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    pieces = F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))

    def joined(p: Column, s: Column, reach: Column) -> Column:
        """reach: the farthest end of the spans before each; a span that starts there or behind it begins a run."""
        shown = F.transform(s, lambda c, i: F.when(c["start"] >= F.get(reach, i), F.concat(_cut(p, F.get(reach, i), c["start"]), F.get(names, c["kind"]))).otherwise(F.lit("")))
        return F.concat(F.array_join(shown, ""), _cut(p, F.array_max(F.transform(s, lambda c: c["end"])), F.length(text)))

    out = _once(pieces, lambda p: _once(placed, lambda s: _once(_before(F.transform(s, lambda c: c["end"]), F.lit(0), lambda x, y: F.greatest(x, y)), lambda reach: joined(p, s, reach))))
    return F.when(F.size(spans) == 0, text).otherwise(out)


def redact(docs: DataFrame) -> DataFrame:
    """The input with all spans in ``text`` replaced; two passes over the texts, none of them shuffled."""
    names = docs.columns
    found = candidates(docs)
    weights = train(found)
    out = found.withColumn("__spans", accepted(weights))
    return out.select(*[redacted(F.col("text"), F.col("__spans")).alias("text") if n == "text" else F.col(n) for n in names])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = on_cluster_disk(candidates(read_documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    weights = train(found)
    out = found.withColumn("spans", accepted(weights))
    base = F.filter("spans", lambda c: c["base"])
    count = lambda kind: F.size(F.filter(base, lambda c: c["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
