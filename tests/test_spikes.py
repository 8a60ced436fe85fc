from __future__ import annotations

import numpy as np
import pytest

from tickloom.operators import spikes
from tickloom.operators.spikes import Rules, implausible, implausible_readings, rolling_median, spikes_in

FRAMES = "index bigint, episode_index bigint, frame_index bigint, timestamp double, task_index bigint, `observation.state` array<float>, action array<float>, day string"
MANIFEST = "rel_path string, task string, episode_index bigint, task_index bigint, length bigint, dataset_source string, recorded_at timestamp, converted_at timestamp"


def walk(rng, n, scale):
    return np.cumsum(rng.normal(0, scale, n))


def episode(rng, n=120, scale=0.01):
    arm = np.stack([walk(rng, n, scale) for _ in range(2)], axis=1)
    grip = (np.arange(n) // 40 % 2).astype(float)[:, None]
    return np.concatenate([arm, grip], axis=1)


def tables(spark, episodes, extra=()):
    rows = [(0, e, t, t / 30, 0, [float(v) for v in x[t]], [float(v) for v in x[t]], "x") for e, x in episodes.items() for t in range(len(x))]
    rows += list(extra)
    manifest = [(f"e{e}", "t", e, 0, len(x), "src", None, None) for e, x in episodes.items()]
    return spark.createDataFrame(rows, FRAMES).repartition(3), spark.createDataFrame(manifest, MANIFEST)


def found(df):
    return {(r.episode_index, r.frame_index, r.feature, r.component) for r in df.collect()}


def test_rolling_median_matches_numpy():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 2))
    starts = np.array([0, 20, 24])
    got = rolling_median(x, starts, 3)
    for a, b in ((0, 20), (24, 50)):
        for i in range(a, b):
            lo = min(max(a, i - 3), b - 7)
            assert np.allclose(got[i], np.median(x[lo : lo + 7], axis=0))
    assert np.allclose(got[20:24], np.median(x[20:24], axis=0))


def test_windows_at_the_ends_are_carried_on():
    x = np.stack([np.arange(40) * 0.5, np.arange(40) * -2.0], axis=1)
    got = spikes.carried_median(x, np.array([0, 20, 29]), 4)
    assert np.allclose(got, x)
    assert np.allclose(spikes.carried_median(x[:1], np.array([0]), 4), x[:1])


def test_the_median_decides_and_neighbours_settle_bursts():
    rng = np.random.default_rng(3)
    t = np.arange(60)
    y = np.sin(t / 9) + rng.normal(0, 0.005, 60)
    for at in ([30], [0], [59], [0, 1, 2], [20, 21, 22, 23], list(range(30, 38)), list(range(53, 60))):
        z = y.copy()
        z[at] += np.where(np.arange(len(at)) % 2, 1.5, 4.5)
        assert np.flatnonzero(spikes.hampel_cases(z, t, 0.6, Rules())).tolist() == at
    z = np.where(t < 30, 0.0, 3.0) + rng.normal(0, 0.005, 60)
    assert not spikes.hampel_cases(z, t, 0.6, Rules()).any()  # a move to another place is none


def test_the_limit_follows_from_the_tail():
    rng = np.random.default_rng(4)
    residual = rng.exponential(0.01, 200_000)
    counts = np.bincount(spikes._bin(residual))
    histogram = {"residual": {i: int(n) for i, n in enumerate(counts) if n}, "step": {i: int(n) for i, n in enumerate(counts) if n}, "positive": {5: 10}}
    for odds in (1e-6, 1e-12):
        got = spikes.normal_behaviour(histogram, Rules(spike_odds=odds))["hampel"]
        assert got == pytest.approx(-0.01 * np.log(odds), rel=0.15)
    assert spikes.normal_behaviour(histogram, Rules(hampel=1000.0))["hampel"] > 5


def test_long_runs_are_seen_across_blocks(spark):
    rules = Rules(rest_share=0.95)
    assert rules.halo > 400 and Rules().halo == spikes.HALO
    rng = np.random.default_rng(6)
    moves = lambda: (np.cumsum(rng.random(900) > 0.9) * 0.01)[:, None]  # stands still in nine frames of ten
    episodes = {e: moves() for e in range(8)}
    episodes[2][200:700] = episodes[2][200]
    frames, manifest = tables(spark, episodes)
    whole = found(implausible_readings(frames, manifest, rules, block=4096))
    first = min(t for e, t, *_ in whole)
    assert first <= 201 and {(2, t, f, 0) for t in range(201, 700) for f in ("observation.state", "action")} <= whole and {e for e, *_ in whole} == {2}
    assert found(implausible_readings(frames, manifest, rules, block=64)) == whole


def test_known_bounds_hold(spark):
    rng = np.random.default_rng(9)
    episodes = {e: episode(rng) for e in range(6)}
    frames, manifest = tables(spark, episodes)
    bounds = {("src", "action", 2): (-0.5, 0.5), ("other", "action", 0): (0.0, 0.0)}
    want = {(e, t, "action", 2) for e, x in episodes.items() for t in range(len(x)) if x[t, 2] == 1}
    assert found(implausible_readings(frames, manifest, bounds=bounds)) == want


def test_spike_burst_between_true_stretches():
    t = np.arange(30)
    y = t * 0.01
    y[10:14] += np.array([3, -2, 4, 2.5])
    assert np.flatnonzero(spikes_in(y, t, 0.2, 7)).tolist() == [10, 11, 12, 13]


def test_burst_at_the_ends_and_fast_motion():
    t = np.arange(40)
    y = np.where(t < 30, 0.0, (t - 30) * 0.15)
    y[:3] = 5
    y[39] = -4
    assert np.flatnonzero(spikes_in(y, t, 0.2, 7)).tolist() == [0, 1, 2, 39]


def test_motion_goes_on_behind_a_stuck_run():
    limits = {"low": -9.0, "high": 9.0, "jump": 0.2, "hampel": 0.1, "stuck": 8.0, "rests": 0.0}
    x = np.concatenate([np.sin(np.arange(10)) * 0.01, np.full(30, 0.02), [0.7, 0.71, 0.78, 0.89]])
    assert np.flatnonzero(implausible(x, np.arange(len(x)), limits, Rules())).tolist() == list(range(11, 40))


def test_stuck_run_flags_repeats_only_and_skips_missing():
    limits = {"low": -9.0, "high": 9.0, "jump": 1.0, "hampel": 0.1, "stuck": 8.0, "rests": 0.0}
    x = np.concatenate([np.arange(5) * 0.1, np.full(12, 0.4), 0.5 + np.arange(5) * 0.1])
    x[8] = np.nan
    cases = np.flatnonzero(implausible(x, np.arange(len(x)), limits, Rules()))
    assert cases.tolist() == [i for i in range(5, 17) if i != 8]


def test_resting_component_only_bounds():
    limits = {"low": -0.25, "high": 1.25, "jump": 0.0, "hampel": 0.0, "stuck": 8.0, "rests": 1.0}
    x = np.array([0.0] * 30 + [17.0, np.inf, np.nan, 1.0])
    assert np.flatnonzero(implausible(x, np.arange(len(x)), limits, Rules())).tolist() == [30, 31]


def test_planted_cases_come_out(spark):
    rng = np.random.default_rng(1)
    episodes = {e: episode(rng) for e in range(30)}
    episodes[3][50, 0] += 4
    episodes[4][0:4, 1] -= 3
    episodes[5][100, 0] = np.inf
    episodes[6][60:90, 1] = episodes[6][60, 1]
    episodes[7][20, 2] = 17
    episodes[8][30, 0] = np.nan
    frames, manifest = tables(spark, episodes)
    want = {(3, 50, 0), (5, 100, 0), (7, 20, 2)} | {(4, t, 1) for t in range(4)} | {(6, t, 1) for t in range(61, 90)}
    expected = {(e, t, f, k) for e, t, k in want for f in ("observation.state", "action")}
    assert found(implausible_readings(frames, manifest)) == expected
    # an episode cut into blocks gives the same
    assert found(implausible_readings(frames, manifest, block=64)) == expected


def test_repeats_nulls_and_unknown_episodes(spark):
    rng = np.random.default_rng(2)
    episodes = {e: episode(rng) for e in range(12)}
    episodes[1][40, 0] = 99
    row = lambda t: (0, 1, t, 0.0, 0, [float(v) for v in episodes[1][t]], None, "x")
    extra = [row(40), row(40), row(41), (0, None, 5, 0.0, 0, [1.0], [1.0], "x"), (0, 1, None, 0.0, 0, [1.0], [1.0], "x"), (0, 77, 0, 0.0, 0, [1.0], [1.0], "x"), (0, 2, 500, 0.0, 0, None, None, "x"), (0, 2, 501, 0.0, 0, [], [], "x")]
    frames, manifest = tables(spark, episodes, extra)
    got = implausible_readings(frames, manifest.unionByName(manifest))
    assert got.count() == len(found(got)) == 2
    assert found(got) == {(1, 40, "observation.state", 0), (1, 40, "action", 0)}


def test_empty_tables(spark):
    frames, manifest = spark.createDataFrame([], FRAMES), spark.createDataFrame([], MANIFEST)
    got = implausible_readings(frames, manifest)
    assert got.count() == 0
    assert got.columns == ["episode_index", "frame_index", "feature", "component"]


@pytest.mark.parametrize("x", [[0.0], [1e-30, 1.0, 1e30], [3.4e38]])
def test_bins_hold_their_numbers(x):
    for v in x:
        b = int(spikes._bin(np.array([v]))[0])
        assert b == 0 if v == 0 else spikes._middle(b) == pytest.approx(v, rel=0.1) or abs(np.log2(v)) >= 48
