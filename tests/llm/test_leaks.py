from __future__ import annotations

import random

import numpy as np
import pytest

from tickloom.llm import leaks

DOCS = "doc_id bigint, text string, item_id int"
ITEMS = "item_id bigint, text string, doc_id int"


def distance(a, b):
    """Least edit distance between a and any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_myers_matches_the_table():
    rng = np.random.default_rng(0)
    for m in (1, 5, 13, 64):
        patterns, texts = rng.integers(1, 4, (60, m)), rng.integers(0, 4, (60, m + 4))
        got = leaks.myers(patterns, texts, 3)
        for p, t, d in zip(patterns, texts, got, strict=True):
            want = distance(p.tolist(), [x or -1 - i for i, x in enumerate(t.tolist())])
            assert d == min(want, 4)
    with pytest.raises(ValueError):
        leaks.myers(np.zeros((1, 65), int), np.zeros((1, 70), int), 1)


def test_pieces():
    assert leaks.pieces_of(13, 1) == [(0, 6), (6, 7)] and leaks.pieces_of(13, 0) == [(0, 13)]
    assert sum(n for _, n in leaks.pieces_of(13, 3)) == 13


def test_words():
    assert leaks.words("Ｆｏｏ_bar-12½ Straße 第二ステーション") == ["foo", "bar", "121", "2", "strasse", "第二ステーション"]
    assert leaks.words(None) == leaks.words(" \n") == []


def test_word_ids_part_by_part(monkeypatch):
    text = "Ｆｏｏ bar\nbaz_qux é e\u0301 long" * 20 + "x" * 50
    known = {w: i + 1 for i, w in enumerate(sorted(set(leaks.words(text))))}
    want = [known[w] for w in leaks.words(text)]
    for part in (1, 7, 64, 10_000):
        monkeypatch.setattr(leaks, "PART", part)
        assert leaks.word_ids(text, known) == want
    assert leaks.word_ids("", known) == []


def test_numbers_of_words(monkeypatch):
    monkeypatch.setattr(leaks, "REMEMBERED", 3)
    known = leaks._Numbers()
    ids = [leaks.word_ids("one two three four five \ud800", known) for _ in range(3)]
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == 5 and 0 not in ids[0] and len(known) <= 3


def brute(docs, items, passage, budget, short=False):
    out = {}
    for d, text in docs:
        w = leaks.words(text)
        for i, item in items:
            v = leaks.words(item)
            best = min((distance(v[o : o + passage], w) for o in range(len(v) - passage + 1)), default=99)
            if short and 0 < len(v) < passage:
                best = 0 if any(w[o : o + len(v)] == v for o in range(len(w))) else 99
            if d is not None and i is not None and best <= budget:
                out[d, i] = min(best, out.get((d, i), 99))
    return out


@pytest.mark.parametrize(("passage", "budget"), [(5, 0), (5, 1), (6, 2), (13, 1)])
def test_against_brute_force(spark, passage, budget):
    rng = random.Random(passage * 10 + budget)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 25)))) for i in range(25)] + [(30, None), (None, "w1 w2 w3 w4 w5 w6 w7")]
    docs = []
    for d in range(60):
        w = rng.choices(vocabulary + ["unknown"], k=rng.randrange(0, 30))
        source = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randrange(0, 3)):
            if source:
                source[rng.randrange(len(source))] = "changed"
        if rng.random() < 0.3 and len(source) > 3:
            del source[rng.randrange(len(source))]
        docs.append((d, " ".join(w[:10] + source + w[10:])))
    docs += [(90, None), (91, ""), (None, items[0][1]), (0, docs[0][1])]
    got = leaks.find_leaks(spark.createDataFrame([(*d, 1) for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, 1) for i in items], ITEMS), passage, budget)
    rows = got.collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    assert {(r.doc_id, r.item_id): r.distance for r in rows} == brute(docs, items, passage, budget)


def test_short_items_are_one_passage(spark):
    items = [(1, "one two three"), (2, "two"), (3, "one two three four five six"), (4, ""), (5, "--"), (6, "nine one")]
    docs = [(1, "zero one two three"), (2, "one two, THREE four five six seven"), (3, "one three two"), (4, "one"), (5, None), (6, "one two three five nine")]
    tables = spark.createDataFrame([(*d, 1) for d in docs], DOCS), spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    for budget in (0, 1):
        got = {(r.doc_id, r.item_id): r.distance for r in leaks.find_leaks(*tables, 5, budget, short=True).collect()}
        assert got == brute(docs, items, 5, budget, True)
        assert {(1, 1), (2, 2), (3, 2)} <= set(got)
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(*tables, 5, 0).collect()} == {(2, 3)}


def test_a_filter_that_is_too_small_and_a_shared_head(spark):
    head = "read the station note and then choose the best option of all these "
    items = spark.createDataFrame([(i, head + " ".join(f"i{i}x{j}" for j in range(20)), 0) for i in range(30)], ITEMS)
    docs = spark.createDataFrame([(d, head + " ".join(f"i{d}x{j}" for j in range(2, 12)), 0) for d in range(30)] + [(99, "read the station note and then choose the best option", 0)], DOCS)
    one = {tuple(r) for r in leaks.find_leaks(docs, items).collect()}
    many = {tuple(r) for r in leaks.find_leaks(docs, items, filter_bits=16).collect()}
    assert one == many and {d for d, *_ in one} == set(range(30))
    assert leaks.find_leaks(docs, items.limit(0)).count() == leaks.find_leaks(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        leaks.find_leaks(docs, items, 5, 5)


def test_a_very_long_text(spark):
    item = " ".join(f"word{i}" for i in range(14))
    docs = spark.createDataFrame([(1, "noise and more " * 100_000 + item + " tail" * 10, 0)], DOCS)
    assert [tuple(r) for r in leaks.find_leaks(docs, spark.createDataFrame([(7, item, 0)], ITEMS)).collect()] == [(1, 7, 0)]
