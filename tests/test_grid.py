from __future__ import annotations

import random

import pytest

from tickloom.operators.grid import regular_grid

MSG = "episode_id string, topic string, log_time bigint, seq bigint, value array<double>, step string, tick int"
REC = "episode_id string, dataset_source string, rel_path string, start_ns bigint, end_ns bigint"
SCH = "dataset_source string, tick_fps double"
STEP = int(1e9 / 30)


def run(spark, messages, recordings, kind="level"):
    rows = regular_grid(spark.createDataFrame(messages, MSG).repartition(2), spark.createDataFrame(recordings, REC), spark.createDataFrame([("s", 30.0), ("still", 0.0)], SCH), kind).collect()
    out = {(r.episode_id, r.topic, r.tick): r for r in rows}
    assert len(out) == len(rows)
    return out


def brute(messages, start, end, kind):
    """One series, one component."""
    read = sorted({(t, s, v[0]) for _, _, t, s, v, *_ in messages if t is not None and v and start <= t < end})
    n = (end - start - 1) // STEP + 1
    out = []
    for k in range(n):
        a, b = start + k * STEP, start + (k + 1) * STEP
        count = sum(a <= t < b for t, *_ in read)
        inc, cov = 0.0, 0
        value = read[0][2] if a <= read[0][0] else read[-1][2]
        for (t0, _, v0), (t1, _, v1) in zip(read, read[1:], strict=False):
            if t1 == t0:
                continue
            fell = kind == "counter" and v1 < v0
            delta = v1 if fell else v1 - v0
            over = max(0, min(t1, b) - max(t0, a))
            inc += delta * over / (t1 - t0)
            cov += over
            if t0 <= a < t1:
                value = v0 if fell else v0 + delta * (a - t0) / (t1 - t0)
        out.append((count, value, inc if cov else None, min(1.0, cov / STEP)))
    return out


@pytest.mark.parametrize("kind", ["level", "counter"])
def test_against_brute_force(spark, kind):
    rng = random.Random(5)
    start, end = 1_700_000_000_000_000_123, 1_700_000_000_000_000_123 + 3_000_000_000
    times = sorted(rng.randrange(start - 10**8, end + 10**8) for _ in range(60)) + [start, end - 1, end]
    level, messages = 0.0, []
    for i, t in enumerate(times):
        level = 0.5 if kind == "counter" and i % 17 == 0 else level + (rng.random() if kind == "counter" else rng.uniform(-1, 1))
        messages.append(("e", "t", t, i, [level], "x", 1))
    messages += messages[:10] + [("e", "t", None, 90, [1.0], "x", 1), ("e", "t", start + 5, 91, None, "x", 1), ("e", "t", start + 6, 92, [], "x", 1)]
    got = run(spark, messages, [("e", "s", "p", start, end)] * 2, kind)
    want = brute(messages, start, end, kind)
    assert len(got) == len(want)
    for k, (count, value, inc, cov) in enumerate(want):
        r = got["e", "t", k]
        assert (r.n_readings, r.missing) == (count, count == 0)
        assert r.value == [pytest.approx(value)]
        assert r.covered == pytest.approx(cov)
        assert r.increment is None if inc is None else r.increment == [pytest.approx(inc)]


def test_counter_reset_is_counted(spark):
    m = [("e", "t", 10 + i * STEP, i, [v], "", 0) for i, v in enumerate([5.0, 9.0, 2.0, 3.0])]
    got = run(spark, m, [("e", "s", "p", 0, 6 * STEP)], "counter")
    assert sum(r.resets for r in got.values()) == 1
    assert sum(r.increment[0] for r in got.values() if r.increment) == pytest.approx(4 + 2 + 1)


def test_a_long_series_crosses_blocks(spark):
    m = [("e", "t", i * STEP * 3000, i, [float(i)], "", 0) for i in range(5)]
    got = run(spark, m, [("e", "s", "p", 0, 13_000 * STEP)])
    assert len(got) == 13_000
    assert got["e", "t", 4500].value == [pytest.approx(1.5)]
    assert got["e", "t", 12_999].value == [4.0]
    assert sum(not r.missing for r in got.values()) == 5


def test_edges(spark):
    rec = [("e", "s", "p", 0, STEP * 3), ("none", "s", "p", 5, 5), ("null", None, "p", 0, 10), ("still", "still", "p", 0, 10), (None, "s", "p", 0, 10)]
    m = [("e", "a", 5, 0, [1.0, 2.0], "", 0), ("e", "b", STEP * 3, 0, [1.0], "", 0), ("none", "a", 5, 0, [1.0], "", 0), ("null", "a", 1, 0, [1.0], "", 0), ("still", "a", 1, 0, [1.0], "", 0), (None, "a", 1, 0, [1.0], "", 0), ("e", None, 1, 0, [1.0], "", 0), ("x", "a", 1, 0, [1.0], "", 0)]
    got = run(spark, m, rec)
    assert set(got) == {("e", "a", k) for k in range(3)}
    assert all(r.value == [1.0, 2.0] and r.increment is None for r in got.values())
    assert run(spark, [], []) == {}
    with pytest.raises(ValueError):
        run(spark, m, rec, "other")


def test_wide_and_odd_vectors_end_nothing(spark):
    """A vector longer than any component of the schemas is a reading, but has no part in the grid's numbers."""
    schemas = spark.createDataFrame([("s", 30.0, [("t", 2)], [("u", 1)])], "dataset_source string, tick_fps double, state_components array<struct<name: string, dim: int>>, action_components array<struct<name: string, dim: int>>")
    rec = spark.createDataFrame([("e", "s", "p", 0, STEP * 8)], REC)
    good = [("e", "t", i * STEP, i, [float(i), -float(i)], "", 0) for i in (0, 2, 6)]
    odd = [("e", "t", STEP * 4, 4, [9.0] * 9, "", 0), ("e", "t", STEP * 7, 7, [9.0] * 5000, "", 0), ("e", "only", 1, 0, [1.0] * 3, "", 0)]
    wide = {(r.topic, r.tick): r for r in regular_grid(spark.createDataFrame(good + odd, MSG), rec, schemas).collect()}
    plain = {(r.topic, r.tick): r for r in regular_grid(spark.createDataFrame(good, MSG), rec, schemas).collect()}
    assert len(wide) == 16 and len(plain) == 8
    for k in range(8):
        a, b = wide["t", k], plain["t", k]
        assert (a.value, a.increment, a.covered) == (b.value, b.increment, b.covered)
        assert (a.n_readings, a.n_unusable) == (b.n_readings + (k in (4, 7)), int(k in (4, 7)))
        assert wide["only", k].value == [] and wide["only", k].missing == (k > 0)


def test_the_width_comes_from_the_data(spark):
    m = [("e", "t", i * STEP, i, [float(i)] * 11, "", 0) for i in range(3)]
    got = run(spark, m, [("e", "s", "p", 0, STEP * 3)])
    assert [got["e", "t", k].value for k in range(3)] == [[float(k)] * 11 for k in range(3)]
