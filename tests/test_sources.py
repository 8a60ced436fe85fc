from __future__ import annotations

import io
import json
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from tickloom import cli, schema
from tickloom.operators import planner
from tickloom.plans import prepare as prep
from tickloom.plans import strategies, train
from tickloom.sources import listing, mcap, root, tar
from tickloom.streaming import incremental


def f64(*x):
    return struct.pack(f"<{len(x)}d", *x)


@pytest.mark.parametrize("compression", ["", "zstd"])
def test_mcap_round_trip(tmp_path, compression):
    rows = [("/a", 5, f64(1.0, 2.0)), ("/b", 6, f64()), ("/a", 7, f64(3.0))]
    mcap.write_mcap(tmp_path / "x.mcap", rows, compression=compression)
    data = (tmp_path / "x.mcap").read_bytes()
    assert [(t, at, s, d) for t, at, s, _, _, d in mcap.messages(data)] == [("/a", 5, 0, f64(1, 2)), ("/b", 6, 1, b""), ("/a", 7, 2, f64(3))]
    assert [s for _, _, s, *_ in mcap.messages(data, {"/a"})] == [0, 2]
    with pytest.raises(mcap.BrokenFile):
        list(mcap.messages(b"no such thing"))


def test_mcap_source(spark, tmp_path):
    spark.dataSource.register(mcap.McapSource)
    for e in ("u1", "u2"):
        d = tmp_path / "data" / "train" / "fold" / f"episode_{e}"
        d.mkdir(parents=True)
        mcap.write_mcap(d / "episode.mcap", [("/a", 1, json.dumps({"value": [1, 2]}).encode()), ("/b", 2, b"[3]")], encoding="json")
    bad = tmp_path / "data" / "train" / "fold" / "episode_bad"
    bad.mkdir()
    (bad / "episode.mcap").write_bytes(b"oops")
    df = spark.read.format("mcap").load(str(tmp_path))
    got = sorted((r.episode_id, r.topic, r.value) for r in df.where("error is null").collect())
    assert got == [(e, t, v) for e in ("u1", "u2") for t, v in (("/a", [1.0, 2.0]), ("/b", [3.0]))]
    assert [r.episode_id for r in df.where("error is not null").collect()] == ["bad"]
    assert df.where("topic = '/b'").count() == 2
    assert spark.read.format("mcap").option("topics", "/a").load(str(tmp_path)).where("topic is not null").count() == 2


def test_tar_source(spark, tmp_path):
    spark.dataSource.register(tar.TarSource)
    names = ["7/videos/head_color.mp4", "7/depth/head_depth_10.png", "7/depth/head_depth_9.png", "389/7/proprio_stats.h5", "8/other.txt"]
    with tarfile.open(tmp_path / "1-9.tar", "w") as t:
        for n in names:
            info = tarfile.TarInfo(n)
            info.size = 3
            t.addfile(info, io.BytesIO(b"abc"))
    read = lambda **o: spark.read.format("tarshard").options(**o).load(str(tmp_path))
    assert read().count() == 5
    some = read(names="389/7/proprio_stats.h5", prefixes="7/depth/")
    assert sorted(r.name for r in some.collect()) == sorted(names[1:4])
    kinds = {r.name: (r.kind, r.episode, r.camera) for r in tar.classify(read(), ["head"]).collect()}
    assert kinds == {names[0]: ("video", "7", "head"), names[1]: ("depth", "7", "head"), names[2]: ("depth", "7", "head"), names[3]: ("proprio", "7", None)}
    wanted = spark.createDataFrame([(names[0],), ("7/none",)], "name string")
    assert [r.name for r in tar.missing_members(read(), wanted).collect()] == ["7/none"]


def test_task_info_and_history(spark, tmp_path):
    for i, entries in ((327, [{"episode_id": 1, "task_name": "pick", "label_info": {"action_config": [{"start_frame": 0, "end_frame": 9, "action_text": "go", "skill": "move"}]}}, {"episode_id": 2, "task_name": "other"}]), (400, []), (500, [{"episode_id": 3, "task_name": "pick"}])):
        (tmp_path / f"task_{i}.json").write_text(json.dumps(entries))
    assert {r.task_name: r.task_id for r in listing.task_info(spark, str(tmp_path)).collect()} == {"pick": 500}
    assert listing.action_segments(spark, str(tmp_path)).where("end_frame = 9").count() == 1
    path = tmp_path / "history"
    path.mkdir()
    (path / "a.json").write_text('{"timestamp": "2024-01-01T00:00:00", "run_name": "x", "metrics": {"loss": 0.5}}\n\n{broken\n')
    listing.record_run(spark.createDataFrame([("2024-01-02T00:00:00", "y", "failed")], "timestamp string, run_name string, status string"), str(path))
    runs = listing.run_history(spark, str(path))
    assert sorted(r.run_name for r in runs.collect()) == ["x", "y"]
    assert cli.main(["history", str(path)]) == 0 and cli.main(["sources"]) == 0


def test_cached_listing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mcap").write_text("x")
    get = lambda **k: listing.cached_listing(spark, str(tmp_path / "in"), str(tmp_path / "cache"), "*.mcap", **k).count()
    assert get() == 1
    (tmp_path / "in" / "b.mcap").write_text("x")
    assert get() == 1 and get(refresh=True) == 2


@pytest.mark.parametrize("path", ["/etc/x", "../x", "a/../../x", ""])
def test_unsafe_paths(path):
    with pytest.raises(root.UnsafeRoot):
        root.safe_relative(path)


def test_wipe_guard(tmp_path):
    for p in ("/", "/root", str(tmp_path)):
        with pytest.raises(root.UnsafeRoot):
            root.wipe(p)
    assert root.resolve_root(None, "s", ["b", "a"]).endswith("datasets/s/a-b")
    assert root.resolve_root("s3://x/y", "s", []) == "s3://x/y"


@pytest.fixture(scope="module")
def small():
    spec = {"dataset_source": "s", "ingestion_strategy": "mcap", "tick_fps": 10.0, "camera_keys": ["top"], "state_components": [["/s", 2]], "action_components": [["/a", 1], ["/g", 1]], "action_spaces": {"a": ["/a"], "g": ["/g"]}}
    return schema.build_schema({**spec, "mcap": {"episode_filename": "episode.mcap"}})


def recorded(spark, episodes, lacking=()):
    rows = [(e, t, 1000 + k * 50_000_000, k, [float(i), float(k)] if t == "/s" else [float(k)]) for i, e in enumerate(episodes) for t in ("/s", "/a", "/g") if (e, t) not in lacking for k in range(12)]
    return spark.createDataFrame(rows, "episode_id string, topic string, log_time bigint, seq bigint, value array<double>")


def listed(spark, names):
    return spark.createDataFrame([(f"data/train/{task}/episode_{e}/episode.mcap", i, e) for i, (task, e) in enumerate(names)], "path string, listing_pos bigint, episode_id string")


def test_prepare_grows_without_gaps(spark, tmp_path, small):
    target = str(tmp_path / "set")
    names = [("fold", "e0"), ("fold", "e1"), ("fold", "e2"), ("fold", "e3")]
    messages = recorded(spark, [e for _, e in names], lacking={("e1", "/a")})
    run = lambda cap, tasks=("fold",), **k: prep.prepare(spark, messages, listed(spark, names), small, list(tasks), cap, target, **k)
    info = run(3)
    assert (info["total_episodes"], info["total_frames"]) == (2, 12)  # e1 lacks a topic
    first = {(r.episode_index, r.frame_index): r["index"] for r in root.read_frames(spark, target).collect()}
    assert sorted(first.values()) == list(range(12)) and {e for e, _ in first} == {0, 1}
    assert run(3) == info
    info = run(4)
    frames = root.read_frames(spark, target).collect()
    assert info["total_episodes"] == 3 and sorted(r["index"] for r in frames) == list(range(18))
    assert {k: v for k, v in ((tuple((r.episode_index, r.frame_index)), r["index"]) for r in frames) if k in first} == first
    assert {r.task for r in frames} == {"fold"} and all(r.timestamp == pytest.approx(r.frame_index / 10) for r in frames)
    manifest = {r.rel_path.split("episode_")[1][:2]: r.episode_index for r in root.read_manifest(spark, target).collect()}
    assert manifest == {"e0": 0, "e2": 1, "e3": 2}
    assert run(1)["total_episodes"] == 1  # a smaller request: all anew
    assert sorted(r.reason for r in prep.rejects(messages, small).collect()) == ["no message of /a"]
    assert cli.main(["verify", target, "--chunk", "3"]) == 0


def test_training_rows(spark, tmp_path, small):
    target = str(tmp_path / "set")
    frames = spark.createDataFrame([(e, t, 0, [float(t), 1.0], [float(10 * t), 5.0]) for e in range(6) for t in range(4)], "episode_index bigint, frame_index bigint, task_index bigint, `observation.state` array<double>, action array<double>")
    tasks = spark.createDataFrame([(0, "fold")], "task_index bigint, task string")
    root.write_root(frames, tasks, small, target, {"image_size": [4, 4]})
    rows = train.training_rows(spark, small, train.TrainRequest(target, 3, action_space="a"))
    r = rows.where("episode_index = 2 and frame_index = 3").first()
    assert r.task == "fold" and r.action == [[30.0]] * 3 and r.action_is_pad == [False, True, True]
    stats = train.dataset_stats(rows, None)
    assert stats["action"].first()["mean"] == pytest.approx(sum(10 * t * min(t + 1, 3) for t in range(4)) / 9)
    request = train.TrainRequest(target, 2, val_fraction=0.3, test_fraction=0.3)
    sides = [{x.episode_index for x in train.training_rows(spark, small, request, s).collect()} for s in ("train", "val", "test")]
    assert set().union(*sides) == set(range(6)) and sum(map(len, sides)) == 6
    with pytest.raises(ValueError, match="not listed"):
        root.write_root(frames, tasks.limit(0), small, str(tmp_path / "other"), {})
    assert train.check_side_schema(small, small) == [] and train.unknown_cameras({"top": "x", "z": "x"}, small) == {"z"}
    with pytest.raises(ValueError, match="camera_keys"):
        train.check_side_schema(small, schema.RobotSchema(**{**small.__dict__, "camera_keys": ()}))


def test_plan_stream(spark, tmp_path):
    source, manifest = str(tmp_path / "in"), str(tmp_path / "manifest")
    kind = "rel_path string, task string, listing_pos bigint"
    add = lambda rows: spark.createDataFrame(rows, kind).write.mode("append").parquet(source)
    run = lambda: incremental.plan_stream(spark.readStream.schema(kind).parquet(source), manifest, str(tmp_path / "cp")).awaitTermination()
    add([("p1", "b", 0), ("p2", "a", 1), ("p2", "a", 1)])
    run()
    add([("p3", "c", 2), ("p1", "b", 3)])
    run()
    got = {r.rel_path: (r.episode_index, r.task_index) for r in spark.read.parquet(manifest).collect()}
    assert got == {"p1": (0, 1), "p2": (1, 0), "p3": (2, 2)}
    assert planner.next_index(spark.read.parquet(manifest), "episode_index").first()[0] == 3


def test_windows_and_sessions_over_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id * 20,0) as ts, id % 2 as k, cast(id as double) as v from range(10)").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, k bigint, v double").parquet(source)
    for name, df in (("w", incremental.windowed(stream, "ts", ["k"], "v")), ("s", incremental.sessions(stream, "ts", ["k"], "50 minutes"))):
        q = df.writeStream.format("memory").queryName(f"stream_{name}").outputMode("complete" if name == "w" else "append").start()
        q.processAllAvailable()
        q.stop()
    assert spark.sql("select sum(n) from stream_w").first()[0] == 10
    batch = incremental.sessions(spark.read.parquet(source), "ts", ["k"], "50 minutes")
    assert sorted((r.k, r.n) for r in batch.collect()) == [(0, 5), (1, 5)]
    assert incremental.windowed(spark.read.parquet(source), "ts", ["k"], "v", "2 hours", "1 hour").where(F.col("n") > 0).count() > 0


def with_cameras(spark, lacking=()):
    """Two episodes: a camera that starts 200 ms before and ends 300 ms after the vectors, by two topics of which one comes first."""
    at = 1_000_000_000
    rows = [(e, t, at + k * 50_000_000, 100 + k, [float(k)] * (2 if t == "/s" else 1), None) for e in ("e0", "e1") for t in ("/s", "/a", "/g") for k in range(12)]
    shots = [-200, -90, 5, 340, 850]
    for e in ("e0", "e1"):
        if e not in lacking:
            rows += [(e, "/top-b", at + ms * 1_000_000, 9 - i, None, f"{e}:{ms}".encode()) for i, ms in enumerate(shots)]
            rows += [(e, "/top-a", at + 5_000_000_000, 50, None, b"other station"), (e, "/top-b", at, 60, None, None)]
    return spark.createDataFrame(rows, "episode_id string, topic string, log_time bigint, seq bigint, value array<double>, data binary")


def test_prepare_carries_cameras(spark, tmp_path, small):
    from bisect import bisect_right

    target = str(tmp_path / "set")
    two = schema.RobotSchema(**{**small.__dict__, "options": {"mcap": {"episode_filename": "episode.mcap", "top_topics": ["/top-a", "/top-b"]}}})
    names = [("fold", "e0"), ("fold", "e1")]
    run = lambda cap, m: prep.prepare(spark, m, listed(spark, names), two, ["fold"], cap, target)
    assert run(1, with_cameras(spark))["total_episodes"] == 1
    info = run(2, with_cameras(spark))  # the first episode is taken over
    ticks = range(-200, 850, 100)  # over all topics
    assert (info["total_episodes"], info["total_frames"]) == (2, 2 * len(ticks)) and info["features"]["camera_frame.top"]["dtype"] == "int64"
    shots = [-200, -90, 5, 340, 850]
    for i, e in enumerate(("e0", "e1")):
        frames = root.read_frames(spark, target).where(f"episode_index = {i}").orderBy("frame_index").collect()
        assert [r["camera_frame.top"] for r in frames] == [bisect_right(shots, t) - 1 for t in ticks]
        assert [r["action"][0] for r in frames] == [float(min(max(t // 50, 0), 11)) for t in ticks]
        kept = root.read_cameras(spark, target).where(f"episode_index = {i}").orderBy("frame").collect()
        assert [(r.camera, r.frame, r.log_time, bytes(r.data)) for r in kept] == [("top", k, 1_000_000_000 + ms * 1_000_000, f"{e}:{ms}".encode()) for k, ms in enumerate(shots)]


def test_prepare_rejects_lacking_camera(spark, tmp_path, small):
    two = schema.RobotSchema(**{**small.__dict__, "options": {"mcap": {"episode_filename": "episode.mcap", "top_topics": ["/top-a", "/top-b"]}}})
    messages = with_cameras(spark, lacking=("e0",))
    info = prep.prepare(spark, messages, listed(spark, [("fold", "e0"), ("fold", "e1")]), two, ["fold"], 5, str(tmp_path / "set"))
    assert info["total_episodes"] == 1
    assert [(r.episode_id, r.reason) for r in prep.rejects(messages, two).collect()] == [("e0", "no message of camera top")]


def descriptors():
    """Vector and camera messages; the file that both import comes last."""
    from google.protobuf import descriptor_pb2

    found = descriptor_pb2.FileDescriptorSet()
    for name, needs, kind, fields in (("m.proto", ["t.proto"], "Joints", (("at", 1, 11, 1), ("position", 2, 1, 3))), ("c.proto", ["t.proto"], "Shot", (("at", 1, 11, 1), ("data", 2, 12, 1), ("format", 3, 9, 1))), ("t.proto", [], "At", (("ns", 1, 3, 1),))):
        file = found.file.add(name=name, package="rec", syntax="proto3", dependency=needs)
        message = file.message_type.add(name=kind)
        for field, number, kind_of, label in fields:
            message.field.add(name=field, number=number, type=kind_of, label=label, type_name=".rec.At" if kind_of == 11 else None)
    return found.SerializeToString()


def write_protobuf(path, vectors, shots):
    """vectors: topic -> width, 12 messages each; shots: (topic, ms) of camera messages."""
    from tickloom.sources.protobuf import message_class

    known = descriptors()
    joints, shot = message_class("rec.Joints", known), message_class("rec.Shot", known)
    rows = [(t, 10**9 + k * 50_000_000, joints(position=[float(k)] * n).SerializeToString()) for t, n in vectors.items() for k in range(12)]
    rows += [(t, 10**9 + ms * 1_000_000, shot(data=f"{t}{ms}".encode(), format="h264").SerializeToString()) for t, ms in shots]
    path.parent.mkdir(parents=True)
    mcap.write_mcap(path, rows, schemas={t: ("rec.Joints", known) for t in vectors} | {t: ("rec.Shot", known) for t, _ in shots}, compression="zstd")


def test_mcap_protobuf_and_uris(spark, tmp_path):
    spark.dataSource.register(mcap.McapSource)
    write_protobuf(tmp_path / "episode_u" / "episode.mcap", {"/s": 2}, [("/top", 7)])
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        rows = spark.read.format("mcap").option("raw", "/top").load(path).orderBy("seq").collect()
        assert [r.error for r in rows] == [None] * 13 and [r.value for r in rows[:12]] == [[float(k)] * 2 for k in range(12)]
        assert (rows[12].value, bytes(rows[12].data), rows[12].format) == (None, b"/top7", "h264")
    lost = spark.read.format("mcap").option("value_field", "effort").load(str(tmp_path)).where("topic = '/s'").collect()
    assert all(r.value is None and r.data for r in lost)
    cut = (tmp_path / "episode_u" / "episode.mcap").read_bytes()[:-60]
    (tmp_path / "episode_u" / "episode.mcap").write_bytes(cut)
    assert "cut off" in spark.read.format("mcap").load(str(tmp_path)).where("error is not null").first().error


@pytest.mark.parametrize("source", [mcap.McapSource, tar.TarSource])
def test_sources_refuse_roots_that_are_not_there(spark, tmp_path, source):
    spark.dataSource.register(source)
    with pytest.raises(Exception, match="does not exist"):
        spark.read.format(source.name()).load(str(tmp_path / "none")).count()


def test_cli_converts_protobuf_recordings(spark, tmp_path):
    s = schema.load_schema("packline")
    vectors = dict((*s.state_components, *s.action_components))
    shots = [("/top", -100), ("/top", 300), ("/left-wrist-camera", 0), ("/right-wrist-camera", 5)]
    write_protobuf(tmp_path / "in/data/train/fold/episode_e0/episode.mcap", vectors, shots)
    write_protobuf(tmp_path / "in/data/train/fold/episode_e1/episode.mcap", vectors, shots[:2])  # no wrist cameras
    assert cli.main(["prepare", "--dataset-source", "packline", "--source-uri", str(tmp_path / "in"), "--tasks", "fold", "--root", str(tmp_path / "out")]) == 0
    frames = root.read_frames(spark, str(tmp_path / "out")).orderBy("frame_index").collect()
    assert [r["camera_frame.top"] for r in frames] == [0] * 8 + [1] * 5 and len(frames[0]["observation.state"]) == s.state_dim
    kept = root.read_cameras(spark, str(tmp_path / "out")).orderBy("camera", "frame").collect()
    assert [(r.camera, bytes(r.data), r.format) for r in kept] == [("left_wrist", b"/left-wrist-camera0", "h264"), ("right_wrist", b"/right-wrist-camera5", "h264"), ("top", b"/top-100", "h264"), ("top", b"/top300", "h264")]


def test_rejects_name_undecoded_topics(spark, small):
    messages = recorded(spark, ["e0"]).withColumn("value", F.when(F.col("topic") != "/g", F.col("value")))
    assert [r.reason for r in prep.rejects(messages, small).collect()] == ["no message of /g"]


def test_training_rows_keep_depth_and_images(spark, tmp_path, small):
    target = str(tmp_path / "set")
    flat = [float(x) for x in range(6)]
    frames = spark.createDataFrame([(0, t, 0, [0.0, 0.0], [float(t), 0.0], [x + t for x in flat], [t, 9], 3 * t) for t in range(3)], "episode_index bigint, frame_index bigint, task_index bigint, `observation.state` array<double>, action array<double>, `depth.head` array<float>, `depth.other` array<int>, `camera_frame.top` bigint")
    tasks = spark.createDataFrame([(0, "fold")], "task_index bigint, task string")
    deep = schema.RobotSchema(**{**small.__dict__, "depth_camera_keys": ("head",)})
    root.write_root(frames, tasks, deep, target, {"image_size": [4, 4]}, depth_shapes={"head": (2, 3, 1)})
    r = train.training_rows(spark, deep, train.TrainRequest(target, 2)).where("frame_index = 1").first()
    assert r["observation.images.depth_head"] == [[[1.0], [2.0], [3.0]], [[4.0], [5.0], [6.0]]]
    assert (r["depth.other"], r["camera_frame.top"], r.action) == ([1, 9], 3, [[1.0, 0.0], [2.0, 0.0]])
    with pytest.raises(ValueError, match="no depth"):
        root.read_training_rows(spark, target, 2, ["other"])


def test_files_are_numbered_by_path(spark, tmp_path):
    for name, size in (("d", 10), ("a", 200), ("c", 90_000), ("b", 5000)):
        (tmp_path / f"{name}.mcap").write_bytes(b"x" * size)
    got = listing.numbered_files(listing.list_files(spark, str(tmp_path))).collect()
    assert sorted((r.listing_pos, r.path[-6:], r["size"]) for r in got) == [(0, "a.mcap", 200), (1, "b.mcap", 5000), (2, "c.mcap", 90_000), (3, "d.mcap", 10)]


def test_a_failed_run_leaves_the_dataset(spark, tmp_path, small, monkeypatch):
    target, names = str(tmp_path / "set"), [("fold", "e0"), ("fold", "e1")]
    messages = recorded(spark, ["e0", "e1"])
    run = lambda cap: prep.prepare(spark, messages, listed(spark, names), small, ["fold"], cap, target)
    info = run(1)
    monkeypatch.setattr(root, "write_rejects", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(2)
    assert root.read_info(target) == {k: v for k, v in info.items() if k != "rejected"} and root.read_frames(spark, target).count() == 6
    monkeypatch.undo()
    assert run(2)["total_episodes"] == 2 and sorted(p.name for p in tmp_path.iterdir()) == ["set"]
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "mine").write_text("x")
    with pytest.raises(root.UnsafeRoot):
        prep.prepare(spark, messages, listed(spark, names), small, ["fold"], 1, str(tmp_path / "other"))


def test_strategies(spark, tmp_path, small):
    source, target = str(tmp_path / "source"), str(tmp_path / "copy")
    frames = spark.createDataFrame([(e, t, 0, [float(t), 1.0], [1.0, 5.0]) for e in range(3) for t in range(4)], "episode_index bigint, frame_index bigint, task_index bigint, `observation.state` array<double>, action array<double>")
    root.write_root(frames, spark.createDataFrame([(0, "fold")], "task_index bigint, task string"), small, source, {"other": 1})
    mirrored = schema.RobotSchema(**{**small.__dict__, "ingestion_strategy": "mirror"})
    request = strategies.Request(source, ["fold"], 5, target)
    for _ in range(2):  # the second time it is there already
        assert strategies.run(spark, mirrored, request)["total_frames"] == 12
    assert root.read_params(target) == schema.conversion_params(mirrored, ["fold"], 5, (224, 224)) and root.read_params(source) == {"other": 1}
    assert sorted(map(tuple, root.read_frames(spark, target).select("episode_index", "frame_index", "index", "task").collect())) == [(e, t, 4 * e + t, "fold") for e in range(3) for t in range(4)]
    with pytest.raises(FileNotFoundError):
        strategies.run(spark, mirrored, strategies.Request(str(tmp_path), ["fold"], 5, str(tmp_path / "none")))
    own = schema.RobotSchema(**{**small.__dict__, "ingestion_strategy": "own", "options": {"own": {"speed": "2"}}})
    with pytest.raises(ValueError, match="'own'"):
        strategies.run(spark, own, request)
    strategies.register("own", strategies.Strategy(lambda s: s.options["own"], lambda _, s, r, options: {**options, "cap": r.cap}))
    assert strategies.run(spark, own, strategies.Request("", [], 7, "", options={"more": "x"})) == {"speed": "2", "more": "x", "cap": 7}
    assert strategies.strategy_of(schema.load_schema("packline")).config(schema.load_schema("packline"))["raw"].startswith("/top")
    with pytest.raises(Exception, match="h5py|no plan"):
        strategies.run(spark, schema.load_schema("softhand"), request)


PLUG_IN = """
import struct

def halves(message, schema):
    return [x / 2 for x in struct.unpack(f"<{len(message) // 2}h", message)]
"""


def test_cli_in_a_session_of_its_own(tmp_path):
    """Recordings in a plug-in encoding, one of them broken off, converted by the command in a process without any of the tests' settings."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = str(Path(__file__).resolve().parent.parent)
    (tmp_path / "code").mkdir()
    (tmp_path / "code" / "plugin_of_a_user.py").write_text(PLUG_IN)
    s = schema.load_schema("packline")
    vectors = dict((*s.state_components, *s.action_components))
    for e in ("e0", "e1", "e2"):
        folder = tmp_path / f"in/data/train/fold/episode_{e}"
        folder.mkdir(parents=True)
        rows = [(t, 10**9 + k * 50_000_000, struct.pack(f"<{n}h", *[k] * n)) for t, n in vectors.items() for k in range(12)]
        rows += [(t, 10**9 + k * 100_000_000, f"{e}{t}{k}".encode()) for topics in s.camera_topics.values() for t in topics[:1] for k in range(5)]
        mcap.write_mcap(folder / "episode.mcap", rows, encoding="halves", compression="zstd")
    broken = tmp_path / "in/data/train/fold/episode_e1/episode.mcap"
    broken.write_bytes(broken.read_bytes()[:-40])
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")} | {"PYTHONPATH": f"{tmp_path / 'code'}", "PYSPARK_PYTHON": sys.executable}
    run = f"import sys; sys.path.insert(0, {repo!r}); from tickloom import cli; sys.exit(cli.main(sys.argv[1:]))"
    done = subprocess.run([sys.executable, "-c", run, "prepare", "--dataset-source", "packline", "--source-uri", str(tmp_path / "in"), "--tasks", "fold", "--root", str(tmp_path / "out"), "--decoders", "halves=plugin_of_a_user:halves"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "2 episodes" in done.stdout and "rejected: e1: broken recording" in done.stdout
    frames = sorted((tmp_path / "out/data").rglob("*.parquet"))
    assert len(frames) == 2 and (tmp_path / "out/meta/rejects.json").is_dir()
    import pyarrow.parquet as pq

    assert pq.read_table(frames[0])["action"][3][0].as_py() in (0.5, 1.0, 1.5)


def test_cli_train_data(spark, tmp_path, capsys):
    s = schema.load_schema("oldgantry")
    frames = spark.createDataFrame([(e, t, 0, [float(t)] * s.state_dim, [float(e)] * s.action_dim) for e in range(12) for t in range(4)], "episode_index bigint, frame_index bigint, task_index bigint, `observation.state` array<double>, action array<double>")
    root.write_root(frames, spark.createDataFrame([(0, "fold")], "task_index bigint, task string"), s, str(tmp_path / "set"), {"image_size": [4, 4]})
    capsys.readouterr()
    assert cli.main(["train-data", str(tmp_path / "set"), "--dataset-source", "oldgantry", "--chunk", "3", "--val-fraction", "0.3", "--relative", "--action-space", "arm"]) == 0
    out = capsys.readouterr().out
    sides = {side: int(n) for side, n, what in (x.replace(":", "").split()[:3] for x in out.splitlines() if x.endswith("episodes"))}
    assert set(sides) == {"train", "val"} and sum(sides.values()) == 12 and f"train: {4 * sides['train']} rows" in out
    assert cli.main(["verify", str(tmp_path / "set"), "--chunk", "3", "--episode", "5"]) == 0
    assert "|5            |" in capsys.readouterr().out
