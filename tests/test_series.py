"""Ordered series, alignment, chunks, splits and statistics against plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import align, chunk, split, stats
from tickloom.operators.ordered import asof, int_bucket, numbered, ranged, running, spread_bucket, text_bucket


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_running_matches_a_loop(spark):
    rng = random.Random(0)
    data = [(k, i, rng.choice([None, rng.randrange(100)])) for k in (1, None) for i in rng.sample(range(-50, 300), 60)]
    df = spark.createDataFrame(data, "k int, i bigint, v bigint")
    for how, inclusive in (("sum", False), ("min", False), ("max", True)):
        got = {(r.k, r.i): r.out for r in running(df, ["k"], ["i"], int_bucket(F.col("i"), 16), "out", F.col("v"), how, inclusive).collect()}
        for k, i, _ in data:
            before = [v for k2, j, v in data if k2 == k and (j < i or inclusive and j == i) and v is not None]
            want = sum(before) if how == "sum" else ({"min": min, "max": max}[how](before) if before else None)
            assert got[k, i] == want, (how, k, i)


def test_numbered_text_order_and_no_keys(spark):
    names = ["b", "abc", "abd", "zz", "", "ä", "abca"]
    got = numbered(spark.createDataFrame([(n,) for n in names], "n string"), [], ["n"], text_bucket(F.col("n")))
    assert [r.n for r in got.orderBy("position").collect()] == sorted(names)
    assert sorted(r.position for r in got.collect()) == list(range(len(names)))


def floor_value(events, t):
    before = [(x, s, v) for x, s, v in events if x <= t]
    return max(before)[2] if before else (min(events)[2] if events else None)


def test_asof_ties_gaps_and_blocks(spark):
    rng = random.Random(1)
    ev = {k: [(rng.randrange(0, 5000), i, float(i)) for i in range(40)] for k in ("a", "b")}
    ev["a"] += [(100, 90, 90.0), (100, 91, 91.0)]
    events = spark.createDataFrame([(k, t, s, v, "x") for k, e in ev.items() for t, s, v in e] + [("a", None, 0, 1.0, "x"), ("a", 4000, 999, None, "x")], "k string, t bigint, s int, v double, mark string")
    ticks = spark.createDataFrame([(k, t, "m") for k in ("a", "b", "none") for t in range(-100, 6000, 77)] + [("a", 100, "m")], "k string, t bigint, mark string")
    got = asof(ticks, events, ["k"], "t", ["s"], "v", 512)
    assert got.columns == ["k", "t", "mark", "v"]
    assert rows(got) == sorted(((r.k, r.t, "m", floor_value(ev.get(r.k, []), r.t)) for r in ticks.collect()), key=repr)


def test_tick_grid_excludes_the_end(spark):
    step = align.tick_step(30)
    assert (step, align.tick_step(15)) == (33_333_333, 66_666_666)
    spans = spark.createDataFrame([("a", 0, step * 3), ("b", 5, 6), ("c", 7, 7), ("d", 9, 3)], "e string, start_ns bigint, end_ns bigint")
    got = sorted((r.e, r.tick_ns) for r in align.tick_grid(spans, step).collect())
    assert got == [("a", 0), ("a", step), ("a", 2 * step), ("b", 5)]
    with pytest.raises(ValueError):
        align.tick_step(0)


def test_align_topics_concatenates_in_order_and_rejects(spark):
    m = [("e", "s", 0, 0, [1.0, 2.0]), ("e", "a", 4, 1, [9.0]), ("e", "s", 10, 2, [3.0, 4.0]), ("f", "s", 0, 0, [1.0, 1.0])]
    df = spark.createDataFrame(m, "e string, topic string, t bigint, seq bigint, v array<double>")
    got = {r.tick_ns: r.vector for r in align.align_topics(df, "e", "topic", "t", "seq", "v", ["s", "a"], 5).collect()}
    assert got == {0: [1.0, 2.0, 9.0], 5: [1.0, 2.0, 9.0]}
    assert rows(align.missing_topics(df, "e", "topic", ["s", "a"])) == [("f", "a")]


def test_first_seen_topic_locks(spark):
    df = spark.createDataFrame([("e", "b", 0), ("e", "a", 1), ("e", "x", 2), ("f", "a", 0)], "e string, topic string, seq int")
    assert rows(align.lock_topic(df, "e", "topic", "seq", ["a", "b"])) == [("e", "b", 0), ("e", "x", 2), ("f", "a", 0)]


def test_fifo_pair_falls_back_to_the_last_time(spark):
    frames = spark.createDataFrame([("e", i) for i in range(4)], "e string, position bigint")
    times = spark.createDataFrame([("e", 0, 10), ("e", 1, 20)], "e string, position bigint, t bigint")
    assert [r.t for r in align.fifo_pair(frames, times, ["e"], "position", "t").orderBy("position").collect()] == [10, 20, 20, 20]


@pytest.mark.parametrize("block", [4, 4096])
def test_chunks_match_numpy(spark, block):
    lengths = {1: 11, 2: 1, 3: 4}
    df = spark.createDataFrame([(e, t, None if (e, t) == (1, 5) else [float(10 * e + t)], "extra") for e, n in lengths.items() for t in range(n)], "e int, t bigint, a array<double>, chunk_size string")
    got = chunk.action_chunks(df, ["e"], "t", "a", 3, block).collect()
    assert len(got) == sum(lengths.values())
    for r in got:
        at = np.arange(r.t, r.t + 3)
        assert r.is_pad == (at >= lengths[r.e]).tolist()
        assert r.chunk == [None if (r.e, i) == (1, 5) else [float(10 * r.e + i)] for i in np.minimum(at, lengths[r.e] - 1)]
    share = chunk.pad_fraction(chunk.action_chunks(df, ["e"], "t", "a", 3, block)).first()
    assert share.n_steps == 48 and share.pad_fraction == pytest.approx(8 / 48) and not share.mostly_padding


def test_chunk_longer_than_episode(spark):
    df = spark.createDataFrame([(0, 0, 7.0)], "e int, t bigint, a double")
    r = chunk.action_chunks(df, ["e"], "t", "a", 5).first()
    assert r.chunk == [7.0] * 5 and r.is_pad == [False] + [True] * 4
    assert chunk.pad_fraction(chunk.action_chunks(df, ["e"], "t", "a", 5)).first().mostly_padding


def test_split_is_that_of_the_hash(spark):
    df = spark.range(500)
    got = {r.id: (r.f, r.s) for r in df.select("id", split.hash_fraction(F.col("id"), 3).alias("f"), split.split_label(F.col("id"), 0.2, 0.3, 3).alias("s")).collect()}
    for i, (f, s) in got.items():
        want = int.from_bytes(hashlib.sha256(f"3:{i}".encode()).digest()[:8], "big") / 2**64
        assert f == want
        assert s == ("val" if want < 0.2 else "test" if want < 0.5 else "train")
    sides = [split.only_split(df, "id", s, 0.2, 0.3, 3).count() for s in ("train", "val", "test")]
    assert sum(sides) == 500 and all(sides)


@pytest.mark.parametrize(("val", "test"), [(-0.1, 0), (0, 1), (0.5, 0.5), (1.5, 0)])
def test_bad_fractions(val, test):
    with pytest.raises(ValueError):
        split.check_fractions(val, test)


def test_empty_split_is_noticed(spark):
    counts = split.split_counts(spark.range(3).withColumnRenamed("id", "e"), "e", 0.0001, 0)
    with pytest.raises(ValueError, match="val"):
        split.check_split(counts, 0.0001, 0)
    split.check_split(split.split_counts(spark.range(100).withColumnRenamed("id", "e"), "e", 0.3, 0), 0.3, 0)


def test_split_predicate_runs_before_the_window(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("e"), F.floor(F.col("id") / 10).alias("t"), F.lit(1.0).alias("a"))
    plan = split.only_split(chunk.action_chunks(df, ["e"], "t", "a", 2), "e", "train", 0.1, 0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("sha2")


def test_stats_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 3)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "i int, `a.b` array<float>")
    got = stats.vector_stats(df, "a.b").orderBy("pos").collect()
    assert np.allclose([r["mean"] for r in got], x.astype(float).mean(axis=0)) and np.allclose([r["std"] for r in got], x.astype(float).std(axis=0))
    assert [r["n"] for r in stats.vector_stats(stats.head(df, "i", 5), "a.b").collect()] == [5] * 3
    pooled = stats.channel_stats(df, "a.b", 1).first()
    assert pooled["std"] == pytest.approx(x.astype(float).std())
    assert stats.vector_stats(df.limit(0), "a.b").count() == 0


def test_valid_actions_only(spark):
    df = spark.createDataFrame([([[1.0], [3.0], [3.0]], [False, False, True])], "chunk array<array<double>>, is_pad array<boolean>")
    r = stats.valid_action_stats(df).first()
    assert (r["mean"], r["std"], r["n"]) == (2.0, 1.0, 2)


def test_buckets_of_any_density(spark):
    """Sparse numbers do not make a bucket each, and texts with a common head do not meet in one."""
    sparse = spark.range(0, 1000).select((F.col("id") * 1_000_003 - 5).alias("i"))
    got = numbered(sparse, [], ["i"], spread_bucket(sparse, "i", 100)).collect()
    assert sorted((r.i, r.position) for r in got) == [(k * 1_000_003 - 5, k) for k in range(1000)]
    assert 8 <= sparse.select(spread_bucket(sparse, "i", 100)).distinct().count() <= 12
    none = sparse.limit(0)
    assert numbered(none, [], ["i"], spread_bucket(none, "i")).count() == 0
    texts = spark.range(3000).select(F.format_string("pick up the thing %05d", F.pmod(F.col("id") * 37, F.lit(3000))).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would put so few texts together
    placed = ranged(texts, ["t"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.select("_bucket").distinct().count() > 1 == texts.select(text_bucket(F.col("t"))).distinct().count()
    assert all(r.t == f"pick up the thing {r.position:05d}" for r in numbered(placed, [], ["t"], F.col("_bucket")).collect())
