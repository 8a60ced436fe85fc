from __future__ import annotations

import random

import pytest

from tickloom.llm.nearest import camera_states, nearest

LEFT = "k string, t bigint, a string, note string, _t string"
RIGHT = "k string, t bigint, b int, note string, a string"


def brute(left, right, tolerance):
    out = set()
    for k, t, a in left:
        near = [(abs(t2 - t), t2, b) for k2, t2, b in right if k2 == k and abs(t2 - t) <= tolerance]
        if near:
            out.add((k, a, min(near)[2]))
    return out


def run(spark, left, right, tolerance, **k):
    l = spark.createDataFrame([(*r, "n", "z") for r in left], LEFT).repartition(3)  # noqa: E741
    r = spark.createDataFrame([(*x, "n", "z") for x in right], RIGHT).repartition(2)
    rows = [tuple(x) for x in nearest(l, r, ["k"], "t", "a", "b", tolerance, **k).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("stretch", [50, 1000, 10**12])
@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_against_brute_force(spark, stretch, batch):
    rng = random.Random(stretch + batch)
    left = [(k, rng.randrange(-300, 3000), f"a{i}") for i, k in enumerate(rng.choices("xyz", weights=[6, 1, 1], k=150))]
    right = [(k, rng.randrange(-300, 3000), i) for i, k in enumerate(rng.choices("xy", weights=[3, 1], k=120))]
    left += left[:20]
    right += right[:20] + [(k, t, b + 1000) for k, t, b in right[:30]]  # several ids at one time
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert run(spark, left, right, 20, stretch=stretch) == brute(left, right, 20)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ties_take_the_earlier(spark):
    assert run(spark, [("x", 10, "a")], [("x", 5, 2), ("x", 15, 1)], 5) == {("x", "a", 2)}
    assert run(spark, [("x", 10, "a")], [("x", 10, 9), ("x", 10, 3)], 0) == {("x", "a", 3)}
    assert run(spark, [("x", 10, "a")], [("x", 16, 1)], 5) == set()


def test_large_times_keep_every_ns(spark):
    t = 1_748_426_097_434_759_424
    assert run(spark, [("x", t, "a"), ("x", t + 60_000_000_001, "b")], [("x", t + 20_000_000, 1), ("x", t + 60_020_000_002, 2)], 20_000_000) == {("x", "a", 1)}


def test_nulls_and_empty(spark):
    left = [("x", None, "a"), (None, 1, "a"), ("x", 1, None), ("x", 1, "ok")]
    right = [("x", 1, None), ("x", None, 1), (None, 1, 1), ("x", 2, 7)]
    assert run(spark, left, right, 5) == {("x", "ok", 7)}
    assert run(spark, [], right, 5) == run(spark, left, [], 5) == set()
    with pytest.raises(ValueError):
        run(spark, left, right, 5, stretch=10)


def test_camera_states(spark):
    recordings = spark.createDataFrame([("e", "s", 0, 10**9)] * 2, "episode_id string, dataset_source string, start_ns bigint, end_ns bigint")
    schemas = spark.createDataFrame([("s", 30.0)], "dataset_source string, tick_fps double")
    shots = [("e", "top", 100, 1, b"x"), ("e", "left_wrist", 100, 1, b"x"), ("e", "right_wrist", 100, 1, b""), ("e", "hand", 100, 1, b"x"), ("e", "top", 200, 2, None), ("e", "top", 10**9, 3, b"x"), ("e", None, 100, 4, b"x"), ("e", "top", 100, None, b"x")]
    camera = spark.createDataFrame(shots * 2, "episode_id string, camera string, log_time bigint, seq bigint, data binary")
    states = [("e", "/left-arm-state", 90, 5, [1.0]), ("e", "/left-arm-state", 101, 6, []), ("e", "/left-arm-state", -1, 7, [1.0]), ("e", "/right-arm-state", 110, 8, [1.0]), ("e", "/other", 100, 9, [1.0])]
    messages = spark.createDataFrame(states, "episode_id string, topic string, log_time bigint, seq bigint, value array<double>")
    got = {tuple(r) for r in camera_states(camera, messages, recordings, schemas).collect()}
    assert got == {("e", "top", 1, 5), ("e", "left_wrist", 1, 5), ("e", "right_wrist", 1, 8)}
