from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import catalog, metrics, planner


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_paths_and_tasks(spark):
    listing = spark.createDataFrame([(0, "data/train/fold cloth/episode_1/e.mcap"), (1, "data/val/fold/episode_2/e.mcap"), (2, "x/train/t/e.mcap"), (3, "data/a.mcap"), (4, "data/train/fold cloth/n/notes.txt"), (5, None)], "pos int, path string")
    got = catalog.task_catalog(listing, suffix=".mcap")
    assert [(r.pos, r.split, r.path_task) for r in got.orderBy("pos").collect()] == [(0, "train", "fold cloth"), (1, "val", "fold"), (2, "unknown", "unknown"), (3, "unknown", "unknown")]
    m = {r.requested: (r.path_task, r.n_matches) for r in catalog.match_tasks(got, ["fold", "cloth", "zzz"], "path_task", "pos").collect()}
    assert m == {"fold": ("fold cloth", 2), "cloth": ("fold cloth", 1), "zzz": (None, 0)}
    with pytest.raises(ValueError, match="zzz"):
        catalog.check_matches(catalog.match_tasks(got, ["zzz"], "path_task", "pos"))
    assert catalog.select_episodes(got, ["fold", "cloth"], "path_task", "pos", 5).count() == 1


def test_numeric_order(spark):
    names = spark.createDataFrame([(x,) for x in ("d_9.png", "d_10.png", "d_010.png", "d.png")], "n string")
    assert {r.n: r.k for r in names.select("n", scalars.trailing_number(F.col("n")).alias("k")).collect()} == {"d_9.png": 9, "d_10.png": 10, "d_010.png": 10, "d.png": None}


def test_shards(spark):
    files = spark.createDataFrame([(0, "o/10-19.tar"), (1, "o/15-5000.tar"), (2, "o/notes.tar"), (3, "o/20-x.tar"), (4, "30-20.tar"), (5, "o/1-99999999999999999999.tar")], "pos int, path string")
    shards = catalog.shards(files, "path", "pos")
    assert shards.count() == 3
    ids = spark.createDataFrame([(10,), (16,), (16,), (2000,), (5,), (None,)], "id bigint")
    assert rows(catalog.resolve_shards(ids, shards, "id", "path", "pos", width=7)) == [(10, "o/10-19.tar"), (16, "o/10-19.tar"), (2000, "o/15-5000.tar"), (5, None)]
    with pytest.raises(Exception, match="no shard holds id 5"):
        catalog.resolve_shards(ids, shards, "id", "path", "pos", require_all=True).collect()


def test_gate():
    old = {"tasks": ["a"], "max_episodes_per_task": 2, "tick_fps": 30.0}
    assert planner.may_reuse(old, {**old, "max_episodes_per_task": 3})
    assert not planner.may_reuse(old, {**old, "max_episodes_per_task": 3}, strict=True)
    assert not planner.may_reuse(old, {**old, "tick_fps": 15.0})
    assert not planner.may_reuse(None, old)


def test_plan_keeps_numbers(spark):
    manifest = spark.createDataFrame([("p1", "b", 0, 0), ("p2", "c", 1, 1)], "rel_path string, task string, episode_index bigint, task_index bigint")
    request = spark.createDataFrame([("p2", "c"), ("p1", "b"), ("p3", "a"), ("p4", "d")], "rel_path string, task string")
    plan = planner.plan(request, manifest, "rel_path", "task", "episode_index")
    assert [sorted(r.rel_path for r in x.collect()) for x in (plan.reused, plan.to_convert, plan.removed)] == [["p1", "p2"], ["p3", "p4"], []]
    assert {r.task: r.task_index for r in plan.task_index.collect()} == {"b": 0, "c": 1, "a": 2, "d": 3}
    assert plan.next_episode_index.first()[0] == 2
    anew = planner.plan(request, manifest, "rel_path", "task", "episode_index", reuse=False)
    assert anew.to_convert.count() == 4 and anew.next_episode_index.first()[0] == 0
    assert {r.task: r.task_index for r in anew.task_index.collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    smaller = planner.plan(request.where("rel_path = 'p1'"), manifest, "rel_path", "task", "episode_index")
    assert [r.rel_path for r in smaller.removed.collect()] == ["p2"]


def test_compaction_and_offsets(spark):
    episodes = spark.createDataFrame([(0, 5), (2, 3), (5, None), (9, 2)], "episode_index bigint, length bigint")
    mapping = planner.compact(episodes, "episode_index")
    assert {r.episode_index: r.new_index for r in mapping.collect()} == {0: 0, 2: 1, 5: 2, 9: 3}
    offsets = planner.with_offsets(episodes)
    assert {r.episode_index: r.offset for r in offsets.collect()} == {0: 0, 2: 5, 5: 8, 9: 8}
    # an index that already holds an offset must not get it twice
    frames = spark.createDataFrame([(2, t, 5 + t) for t in range(3)], "episode_index bigint, frame_index bigint, index bigint")
    once = planner.global_index(frames, offsets)
    assert rows(planner.global_index(once.select(frames.columns), offsets).select("frame_index", "index")) == [(0, 5), (1, 6), (2, 7)]
    assert {r.episode_index for r in planner.renumber(frames, mapping).collect()} == {1}
    assert rows(planner.missing_tasks(spark.createDataFrame([(1,), (2,)], "task_index int"), spark.createDataFrame([(1,)], "task_index int"))) == [(2,)]


def loop_patience(losses, windows):
    best, waited, out = None, 0, []
    for loss, w in zip(losses, windows, strict=True):
        better = best is None or loss < best
        if better:
            best = loss
        if w:
            waited = 0 if better else waited + 1
        out.append(waited)
    return out


def test_patience_and_best(spark):
    losses = [5.0, 5.0, 6.0, 4.0, 4.0, 4.0, 3.9, 7.0, 7.0, 7.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(losses)], "step bigint, loss double")
    got = metrics.patience(df, [], "step", "loss", 3).orderBy("step").collect()
    assert [r.waited for r in got] == loop_patience(losses, [True] * 10)
    assert [r.improved for r in got] == [True, False, False, True, False, False, True, False, False, False]
    assert [r.step for r in got if r.stop] == [9]
    windows = [i % 3 != 2 for i in range(10)]
    df = spark.createDataFrame([(i, x, w) for i, (x, w) in enumerate(zip(losses, windows, strict=True))], "step bigint, loss double, is_window boolean")
    assert [r.waited for r in metrics.patience(df, [], "step", "loss", 3).orderBy("step").collect()] == loop_patience(losses, windows)


def test_windows_reset_at_epochs(spark):
    df = spark.createDataFrame([(s, (s - 1) // 7, float(s)) for s in range(1, 21)], "step bigint, epoch bigint, loss double")
    got = {r.step: (r["mean"], r.n) for r in metrics.window_means(df, [], "step", "epoch", "loss", 5).collect()}
    assert got == {5: (3.0, 5), 10: (9.0, 3), 15: (15.0, 1), 20: (18.0, 5)}


def test_retention_and_resume(spark):
    df = spark.createDataFrame([("r", s, x, s // 2, c) for s, (x, c) in enumerate([(3.0, True), (1.0, True), (1.0, None), (2.0, False), (9.0, False)])], "run string, step bigint, loss double, epoch bigint, complete boolean")
    kept = metrics.retained(df.select("run", "step", "loss"), ["run"], "step", "loss", 2)
    assert sorted(r.step for r in kept.collect()) == [1, 2, 4]
    assert sorted(r.step for r in metrics.retained_improving(df.select("run", "step", "loss"), ["run"], "step", "loss", 1).collect()) == [1]
    assert metrics.resume_epoch(df, ["run"], "step", "epoch", "complete").first().resume_epoch == 2
    assert metrics.resume_epoch(df.where("step < 3"), ["run"], "step", "epoch", "complete").first().resume_epoch == 2


def test_ranks(spark):
    batches = spark.createDataFrame([(r, b) for r, n in ((0, 5), (1, 3)) for b in range(n)], "rank int, b int")
    assert metrics.common_batches(batches, "rank").first()[0] == 3
    assert metrics.common_batches(batches, "rank", 2).first()[0] == 2
    assert metrics.common_batches(batches.limit(0), "rank").first()[0] == 0
    decisions = spark.createDataFrame([(1, 0, True), (1, 1, False)], "step int, rank int, stop boolean")
    assert [r.stop for r in metrics.led(decisions, spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "step int, rank int"), ["step"], "rank").collect()] == [True] * 3
    assert metrics.concurrency(8, 3, 100, 30) == 2 and metrics.concurrency(1, 3, 100, 30) == 1


def one(spark, expr, *values, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr(F.col("x"))).collect()]


def test_scalars(spark):
    assert one(spark, scalars.is_safe_path, "a/b", "a/../b", "a/../../b", "/a", "..", "a/./b", "", "./..") == [True, True, False, False, False, True, False, False]
    assert [tuple(x) if x else None for x in one(spark, scalars.key_value, "a=1", "a = b=c", "none", "=x")] == [("a", "1"), ("a", " b=c"), None, ("", "x")]
    assert [tuple(x) if x else None for x in one(spark, scalars.span_pair, "1:5", "5:1", "3:3", "a:4", "7")] == [(1, 5), None, None, None, None]
    assert one(spark, scalars.codec, "H264", "avc", "HEVC", "vp9", None) == ["h264", "h264", "hevc", None, None]
    assert [tuple(x) if x else None for x in one(spark, scalars.hub_uri, "hf://datasets/a/b", "hf://a/b", "s3://x/y", None)] == [("dataset", "a/b"), ("model", "a/b"), None, None]
    assert one(spark, scalars.uri_scheme, "S3://x", "gs://y", "/local", None) == ["s3", "gs", "file", None]
    with pytest.raises(Exception, match="which codec"):
        one(spark, lambda x: scalars.require(scalars.codec(x), "which codec"), "vp9")


def test_globs(spark):
    import fnmatch

    names = ["loss", "train/loss", "val/loss", "perf/gpu_0", "perf/gpu_1", "a.b", "aXb"]
    for g in ("loss", "*/loss", "perf/gpu_?", "[!t]*", "perf/gpu_[01]", "a.b", "*", "[a"):
        assert one(spark, lambda x, g=g: scalars.glob_filter(x, [g]), *names) == [fnmatch.fnmatchcase(n, g) for n in names], g
    assert one(spark, lambda x: scalars.glob_filter(x, None, ["*/loss"]), *names).count(False) == 2


def test_even_positions(spark):
    import numpy as np

    for n in (1, 2, 5):
        got = one(spark, lambda x, n=n: scalars.even_positions(x, n), 0, 1, 7, 100, schema="x bigint")
        assert got == [[]] + [np.linspace(0, t - 1, n).astype(int).tolist() for t in (1, 7, 100)]


def test_history_line(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' as t, 'ok' as s, cast(null as double) as l union all select timestamp'2024-01-02 03:04:05', 'ok', 0.12345")
    assert sorted(r[0] for r in df.select(scalars.history_line(F.col("t"), F.col("s"), F.col("l"))).collect()) == ["2024-01-02T03:04:05 ok 0.1235", "2024-01-02T03:04:05 ok n/a"]
