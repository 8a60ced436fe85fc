from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import spans

DOCS = "doc_id bigint, text string, rep int, place string, digest string"


def brute(docs, n):
    seen = {}
    for d, t in docs:
        if d is not None and t:
            for i in range(len(t) - n + 1):
                seen.setdefault(t[i : i + n], set()).add(d)
    out = {}
    for d, t in docs:
        if d is None or not t:
            continue
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if len(seen[t[i : i + n]]) > 1:
                hit[i : i + n] = True
        if hit.any():
            out[d] = max(int(hit.sum()), out.get(d, 0))
    return out


def run(spark, docs, n, **k):
    df = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], DOCS).repartition(3)
    rows = spans.shared_spans(df, n, **k).collect()
    assert len(rows) == len({r.doc_id for r in rows})
    return {r.doc_id: r.shared_chars for r in rows}


@given(st.text(alphabet="abé測😀", max_size=60), st.integers(1, 20))
@settings(max_examples=100, deadline=None)
def test_equal_windows_have_equal_hashes(text, size):
    h = spans.window_hashes(spans.code_points(text), size)
    windows = [text[i : i + size] for i in range(len(text) - size + 1)]
    assert len(h) == len(windows)
    assert len(set(h.tolist())) == len(set(windows))
    by = {}
    for w, x in zip(windows, h.tolist(), strict=True):
        assert by.setdefault(w, x) == x


@pytest.mark.parametrize("n", [10, 21])
@pytest.mark.parametrize("together", [spans.TOGETHER, 1])
def test_against_brute_force(spark, n, together):
    rng = random.Random(n)
    letters = "abcdefgh 測試😀é"
    passages = ["".join(rng.choices(letters, k=rng.randrange(n // 2, 4 * n))) for _ in range(8)]
    docs = []
    for d in range(40):
        t = "".join(rng.choices(letters, k=rng.randrange(0, 60)))
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(t) + 1)
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            t = t[:at] + rng.choice([p, p[cut:], p[:cut], p + p]) + t[at:]
        docs.append((d, t))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (5, docs[5][1]), (102, None), (103, ""), (None, docs[7][1]), (104, "z" * 50), (105, "q" * 50), (106, "q" * 40)]
    docs += [(110, docs[4][1] + "!" + docs[6][1]), (110, docs[8][1] * 2), (111, docs[8][1] + docs[9][1])]  # two texts under one id
    # together = 1: every seed counts as one that very many texts have
    assert run(spark, docs, n, together=together) == brute(docs, n)


def test_texts_of_one_id_share_nothing_with_each_other(spark):
    a, b = "the quick brown fox jumps over", "over the lazy dog and away it goes"
    docs = [(1, a + b), (1, b + a), (2, "not the same at all, in no way whatsoever")]
    for together in (spans.TOGETHER, 1):
        assert run(spark, docs, 20, together=together) == {}
        assert run(spark, [*docs, (3, a + b)], 20, together=together) == {1: 64, 3: 64}
        assert run(spark, [*docs, (0, "xx" + b)], 20, together=together) == {0: 34, 1: 34}


@pytest.mark.parametrize("letter", ["a", "ab", "abc "])
def test_texts_that_repeat_themselves(spark, letter):
    docs = [(1, letter * 700), (2, "x" * 40 + letter * 90), (3, letter * 30 + "y"), (4, "y" * 300)]
    for together in (spans.TOGETHER, 1):
        assert run(spark, docs, 50, together=together) == brute(docs, 50)
    _, _, places = zip(*spans.seeds_of([letter * 3000], 100), strict=True)
    assert sum(map(len, places)) < 3000 * len(letter) / 12  # equal windows are not all seeds


def test_ids_of_another_kind(spark):
    t = "a passage that is long enough to be looked at by this test"
    df = spark.createDataFrame([("b", "x " + t), ("a", t + " y"), ("c", "nothing of the kind"), (None, t)], "doc_id string, text string")
    assert {r.doc_id: r.shared_chars for r in spans.shared_spans(df, 30).collect()} == {"a": len(t), "b": len(t)}


def test_inside_one_text_only_is_not_shared(spark):
    t = "the quick brown fox jumps over the lazy dog "
    assert run(spark, [(1, t * 5), (2, "something else entirely, which is long enough")], 20) == {}
    assert run(spark, [(1, t * 5), (2, t)], 20) == {1: 5 * len(t), 2: len(t)}


def test_a_third_of_all_texts_share_one_passage(spark):
    rng = random.Random(1)
    noise = lambda k: "".join(rng.choices("abcdefghijklmnop", k=k))
    passage = noise(130)
    docs = [(d, noise(30) + (passage if d % 3 == 0 else "") + noise(30)) for d in range(90)] + [(1000 + d, passage + "same") for d in range(40)]
    assert run(spark, docs, 100) == brute(docs, 100)


@pytest.mark.parametrize("stretch", [1, 64, 1000])
def test_stretches_of_a_long_text(spark, stretch, monkeypatch):
    rng = random.Random(stretch)
    text = "".join(rng.choices("ab c", k=997))
    whole = {n: sorted((h, p) for hashes, _, place in spans.seeds_of([text], n) for h, p in zip(hashes.tolist(), place.tolist(), strict=True)) for n in (8, 13)}
    monkeypatch.setattr(spans, "STRETCH", stretch)
    for span in (7, 10):
        parts = list(spans.stretches_of(997, span))
        starts = [i for begin, end in parts for i in range(begin, end - span + 1)]
        assert starts == list(range(997 - span + 1)) and all(begin % span == 0 for begin, _ in parts)
    assert list(spans.stretches_of(3, 7)) == [(0, 3)]
    for n, seeds in whole.items():
        assert seeds == sorted({(h, p) for hashes, _, place in spans.seeds_of([text], n) for h, p in zip(hashes.tolist(), place.tolist(), strict=True)})
        places = np.array([p for _, p in seeds])
        assert all(((places >= q) & (places <= q + n - n // 2)).any() for q in range(997 - n + 1))  # one in every span


def test_a_very_long_text(spark):
    rng = np.random.default_rng(0)
    words = rng.integers(97, 123, 3_000_000).astype(np.uint8).tobytes().decode()
    cut = words[1_048_500:1_048_700]  # across the border of two stretches
    assert run(spark, [(1, words), (2, "other " + cut), (3, "nothing in common with the others, but long enough to be looked at, and even a bit longer than that")], 100) == {1: 200, 2: 200}


def test_empty(spark):
    assert run(spark, [], 100) == {} and run(spark, [(1, "short")], 100) == {}
    with pytest.raises(ValueError):
        run(spark, [(1, "x")], 1)
