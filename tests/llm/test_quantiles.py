from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import quantiles as q

SHARES = [0.0, 0.01, 0.3, 0.5, 0.77, 1.0]


def off_by(values, share, got):
    """Ranks between the wanted one and those that got has among values."""
    y = np.sort(values)
    want = min(max(1, math.ceil(share * len(y))), len(y))
    low, high = np.searchsorted(y, got, "left") + 1, np.searchsorted(y, got, "right")
    assert high >= low, "not a reading"
    return max(0, low - want, want - high)


@given(st.lists(st.floats(-5, 5, width=16), min_size=1, max_size=400), st.integers(1, 9), st.integers(2, 5), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_error_bound_holds_after_merging(values, k, fan_in, n_sketches):
    parts = np.array_split(np.array(values), n_sketches)
    total = q.Sketch(k, fan_in)
    for part in parts:
        s = q.Sketch(k, fan_in)
        for piece in np.array_split(part, 3):
            s.add(piece)
        for stored in s.parts():
            total.take(*stored)
    assert total.n == len(values)
    for share, got in zip(SHARES, total.quantiles(SHARES), strict=True):
        assert off_by(values, share, got) <= total.err


def test_sorted_and_reversed_input_keep_the_bound():
    for x in (np.arange(200_000.0), np.arange(200_000.0)[::-1]):
        s = q.Sketch(64, 4)
        s.add(x)
        assert s.err / s.n < 0.06
        assert all(off_by(x, share, got) <= s.err for share, got in zip(SHARES, s.quantiles(SHARES), strict=True))
        assert sum(len(v) for *_, v in s.parts()) <= 64 * 4 * 9


def test_few_readings_are_exact():
    s = q.Sketch(16, 4)
    s.add(np.array([3.0, 1.0, 2.0]))
    assert s.err == 0 and s.quantiles([0.5]).tolist() == [2.0]
    assert np.isnan(q.Sketch().quantiles([0.5])[0])
    with pytest.raises(ValueError):
        q.Sketch(0)


def test_column_with_a_hot_key_nulls_and_many_parts(spark):
    rng = np.random.default_rng(3)
    values = {"hot": rng.normal(size=6000), "b": rng.normal(size=50), None: rng.normal(size=7)}
    rows = [(k, float(v), "x") for k, x in values.items() for v in x] + [("hot", None, "x"), ("hot", float("nan"), "x"), ("hot", float("inf"), "x"), ("empty", None, "x")]
    df = spark.createDataFrame(rows, "g string, v double, n string").repartition(40)
    got = {(r.g, r.q): r for r in q.quantiles(df, ["g"], "v", [0.1, 0.5], k=32, fan_in=3, n_parts=40).collect()}
    assert len(got) == 8
    for (g, share), r in got.items():
        if g == "empty":
            assert r.n == 0 and math.isnan(r.value)
            continue
        assert r.n == len(values[g]) and r.error_share == r.rank_error / r.n
        assert off_by(values[g], share, r.value) <= r.rank_error
    assert got["b", 0.5].rank_error <= 2
    assert q.quantiles(df.limit(0), ["g"], "v", [0.5], n_parts=1).count() == 0


def test_keys_of_any_name(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 4.0)], "part bigint, `level.x` string, readings double")
    assert [tuple(r)[:5] for r in q.quantiles(df, ["part", "level.x"], "readings", [1.0], n_parts=2).collect()] == [(1, "a", 1.0, 4.0, 2)]
    for bad in ([], ["q"]):
        with pytest.raises(ValueError):
            q.quantiles(df.withColumnRenamed("part", "q"), bad, "readings", [0.5], n_parts=1)


FRAMES = "index bigint, episode_index bigint, frame_index bigint, timestamp double, task_index bigint, `observation.state` array<float>, action array<float>, day string"
MANIFEST = "rel_path string, episode_index bigint, dataset_source string, recorded_at timestamp, feature string"


def test_frames_by_day_and_at_once(spark):
    import datetime

    rng = np.random.default_rng(4)
    data = {(e, t): rng.normal(size=3).astype(np.float32) for e in range(12) for t in range(40)}
    data[0, 3][1] = np.nan
    data[0, 4][1] = np.inf
    rows = [(0, e, t, 0.0, 0, [float(v) for v in x], None if t == 5 else [float(x[0])], "d") for (e, t), x in data.items()]
    frames = spark.createDataFrame(rows + rows[:30] + [(0, 99, 0, 0.0, 0, [1.0], [1.0], "d")], FRAMES)
    source = lambda e: "big" if e < 8 else "small"
    manifest = spark.createDataFrame([("p", e, source(e), None if e == 1 else datetime.datetime(2024, 1, 1 + e % 3), "f") for e in range(12)] * 2, MANIFEST)
    at_once = {tuple(r[:4]): r for r in q.frame_percentiles(frames, manifest, [0.5, 0.9], k=16).collect()}
    days = q.day_sketches(frames, manifest, k=16)
    assert days.select("day").distinct().count() == 4
    by_day = {tuple(r[:4]): r for r in q.percentiles_of_days(days, [0.5, 0.9], k=16).collect()}
    assert set(at_once) == set(by_day) and len(at_once) == 2 * 4 * 2
    for got in (at_once, by_day):
        for (s, feature, c, share), r in got.items():
            x = np.array([v[c] for (e, t), v in data.items() if source(e) == s and not (feature == "action" and t == 5)], float)
            x = x[np.isfinite(x)]
            assert r.n == len(x) and off_by(x, share, r.value) <= r.rank_error < 0.25 * r.n
    assert q.frame_percentiles(frames.limit(0), manifest).count() == 0


def test_sketches_are_given_out_by_bytes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(g, float(v)) for g in range(40) for v in rng.normal(size=60)], "g bigint, v double").repartition(1).sortWithinPartitions("v")
    whole = {(r.g, r.q): r.value for r in q.quantiles(df, ["g"], "v", [0.25, 0.5], k=64, n_parts=1).collect()}
    import pyarrow as pa

    batch = pa.table({"g": [i % 40 for i in range(2400)], "v": rng.normal(size=2400)}).to_batches(max_chunksize=100)

    def feed(b):
        for g, v in zip(b["g"].to_pylist(), b["v"].to_pylist(), strict=True):
            yield (g,), np.array([v])

    monkeypatch.setattr(q, "HELD_BYTES", 20_000)
    out = list(q.sketch_batches(batch, feed, ["g"], [pa.int64()], 16, 4, "f8"))
    assert len(out) > 10 and sum(sum(b["n"].to_pylist()) for b in out) == 2400
    assert all(b["readings"].nbytes < 40_000 for b in out)
    assert len(whole) == 80


def test_buffer_size():
    assert q.buffer_size(0.005, 10**9) <= 1024 < q.buffer_size(0.001, 10**9)
    rng = np.random.default_rng(1)
    for error in (0.05, 0.01):
        s = q.Sketch(q.buffer_size(error, 100_000))
        s.add(rng.random(100_000))
        assert 0 < s.err / s.n <= error
    for bad in (0, 1, -0.1):
        with pytest.raises(ValueError):
            q.buffer_size(bad, 10)
