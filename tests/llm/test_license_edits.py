"""Copies of a notice with words inserted, deleted, replaced and repeated, against the share of its grams that are left."""

import pytest

from docflow.llm import licenses

MIT = licenses.NOTICES[0].text.split()
GPL = licenses.NOTICES[5].text.split()
AROUND = ([f"before{i}" for i in range(9)], [f"after{i}" for i in range(9)])


def edit(words, at, delete, *insert):
    return [*words[:at], *insert, *words[at + delete :]]


def held(template, document):
    """Share of the template's grams of three words that occur in a document which holds one copy."""
    own = {tuple(document[i : i + 3]) for i in range(len(document) - 2)}
    grams = [tuple(template[i : i + 3]) for i in range(len(template) - 2)]
    return sum(g in own for g in grams) / len(grams)


COPIES = {
    "unchanged": MIT,
    "one inserted in the middle": edit(MIT, 14, 0, "font"),
    "three inserted in the middle": edit(MIT, 14, 0, "font", "and", "type"),
    "inserted in three places": edit(edit(edit(MIT, 21, 0, "x1"), 14, 0, "x2", "x3"), 7, 0, "x4"),
    "one deleted in the middle": edit(MIT, 14, 1),
    "three deleted in the middle": edit(MIT, 14, 3),
    "one replaced in the middle": edit(MIT, 14, 1, "font"),
    "six replaced by eight": edit(MIT, 10, 6, *(f"y{i}" for i in range(8))),
    "six replaced by four": edit(MIT, 10, 6, *(f"y{i}" for i in range(4))),
    "inserted, then deleted": edit(edit(MIT, 20, 2), 8, 0, "z1", "z2"),
    "half of it": MIT[:14],
}


@pytest.mark.parametrize("name", COPIES)
def test_edited_notice(documents, name):
    document = [*AROUND[0], *COPIES[name], *AROUND[1]]
    got = licenses.scan(documents([(1, " ".join(document))]), licenses.BASE, [licenses.NOTICES[0]]).first()
    want = held(MIT, document)
    assert got.score == pytest.approx(want)
    assert got.labels == ("mit" if want >= licenses.COVERAGE else "")
    assert [(s.first, s.end) for s in got.spans] == ([(9, 9 + len(COPIES[name]))] if want >= licenses.COVERAGE else [])


def test_repeats_of_a_passage_count_once(documents):
    document = " ".join(["and or modify"] * 30)
    got = licenses.scan(documents([(1, document)]), licenses.BASE, [licenses.NOTICES[5]]).first()
    assert got.labels == "" and got.score == pytest.approx(1 / (len(GPL) - 2))


def test_two_copies_stay_two_spans(documents):
    document = " ".join([*edit(MIT, 14, 0, "font"), *AROUND[0], *edit(MIT, 14, 1)])
    got = licenses.scan(documents([(1, document)]), licenses.BASE, [licenses.NOTICES[0]]).first()
    assert [(s.first, s.end) for s in got.spans] == [(0, 30), (39, 67)]
