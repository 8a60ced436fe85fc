from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tickloom import config, schema
from tickloom.functions import udf
from tickloom.operators import align, catalog, images, metrics
from tickloom.plans import train
from tickloom.sources import decode, transfer


def test_user_functions(spark):
    df = spark.range(10).repartition(3)
    assert sorted(r.id for r in udf.map_rows(df, lambda r, k: {"id": r["id"] * k}, fn_args=(2,)).collect()) == list(range(0, 20, 2))
    assert udf.flat_map(df, lambda r: ({"v": str(i)} for i in range(r["id"])), "v string").count() == 45
    assert sorted(r.id for r in udf.filter_rows(df, lambda r: r["id"] > 7).collect()) == [8, 9]
    double = lambda b: b.set_column(0, "id", pc.multiply(b["id"], 2))
    assert sum(r.id for r in udf.map_batches(df, double, batch_size=2).collect()) == 90

    class Adder:
        def __init__(self, by):
            self.by = by

        def __call__(self, batch):
            return pa.table({"id": pc.add(batch["id"], self.by)})

    assert sum(r.id for r in udf.map_batches(df, Adder, fn_constructor_kwargs={"by": 100}).collect()) == 1045
    safe = udf.flat_map(df, udf.tolerant(lambda r: [{"v": 1 // (r["id"] % 2)}]), "v bigint, error string").collect()
    assert sum(r.v is None and "ZeroDivisionError" in r.error for r in safe) == 5
    assert sum(b.num_rows for b in udf.iter_batches(df, 4)) == 10
    assert udf.map_rows(df.limit(0), lambda r: r).count() == 0


def test_transfer(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "a" / "x.bin").write_bytes(b"12345")
    src, cache = str(tmp_path / "in"), str(tmp_path / "cache")
    paths = spark.createDataFrame([("a/x.bin",), ("a/none",), ("../in/a/x.bin",), (None,), ("a/x.bin",)], "path string")
    got = {r.path: (r.size, r.error is None) for r in transfer.fetch_all(paths, src, cache).collect()}
    assert got == {"a/x.bin": (5, True), "a/none": (None, False), "../in/a/x.bin": (None, False)}
    (tmp_path / "in" / "a" / "x.bin").write_bytes(b"changed later")
    assert open(transfer.fetch_one(spark, src, "a/x.bin", cache), "rb").read() == b"12345"
    with pytest.raises(ValueError):
        transfer.fetch_one(spark, src, "/etc/passwd", cache)
    assert transfer.hub_parts("hf://datasets/a/b") == ("dataset", "a/b") and transfer.hub_parts("hf://a/b") == ("model", "a/b")
    with pytest.raises(ValueError):
        transfer.hub_parts("s3://a")


def test_decoders_reject_row_by_row(spark):
    members = spark.createDataFrame([("a/d_10.png", b"no image"), ("a/d_9.png", b"")], "name string, content binary")
    got = decode.depth_rows(members, 2, 2).collect()
    assert len(got) == 2 and all(r.error for r in got)
    assert decode.hdf5_rows(members, ["x"]).where("error is not null").count() == 2
    assert decode.video_rows(members, 2, 2).where("error is not null").count() == 2
    with pytest.raises(decode.MissingDecoder):
        decode.library("no_such_library")
    x = np.arange(16).reshape(4, 4)
    assert decode.nearest_resize(x, 4, 4).tolist() == x.tolist() and set(decode.nearest_resize(x, 2, 3).ravel()) <= set(range(16))


def test_config(tmp_path):
    assert config.parse_pairs(["a=1", "b = 2"], int) == {"a": 1, "b": 2}
    assert config.parse_span("3:9") == (3, 9)
    for bad in ("x", "5:5", "9:1"):
        with pytest.raises(ValueError):
            config.parse_span(bad)
    with pytest.raises(ValueError):
        config.parse_pairs(["a"])
    path = tmp_path / "c.yaml"
    path.write_text("root: /data\nchunk_size: 7\nval_fraction: 0.2\n")
    base = config.load_request(str(path))
    out = config.override(base, {"chunk_size": 50, "val_fraction": 0.1}, {"chunk_size": 50, "val_fraction": 0.0})
    assert (out.chunk_size, out.val_fraction, out.root) == (7, 0.1, "/data")
    path.write_text("nonsense: 1\n")
    with pytest.raises(ValueError, match="nonsense"):
        config.load_request(str(path))
    assert config.merged({"a": 1, "b": 1}, {"b": 2}) == {"a": 1, "b": 2}


def test_small_parts(spark):
    assert images.visual_features(["top"], ["head"], 4, 5) == {"observation.images.top": (3, 4, 5), "observation.images.depth_head": (3, 4, 5)}
    df = spark.createDataFrame([(1, 2, 3, 4)], "top int, `observation.images.left` int, `depth.head` int, task int")
    once = images.prefixed(df, ["top", "observation.images.left"], ["head"])
    assert once.columns == ["observation.images.top", "observation.images.left", "observation.images.depth_head", "task"]
    records = spark.createDataFrame([(0, None), (1, {"head": None}), (2, {"head": [4, 5, 1]}), (3, {"head": [9, 9, 1]})], "i int, depth_shapes map<string,array<int>>")
    assert [tuple(r) for r in catalog.first_shapes(records, "i").collect()] == [("head", [4, 5, 1])]
    wide = spark.createDataFrame([(1, 2.0, None)], "step int, loss double, acc double")
    assert [tuple(r) for r in metrics.metric_rows(wide, "val", "step", ["loss", "acc"]).collect()] == [(1, "val/loss", 2.0)]
    ticks = spark.createDataFrame([("e", 0), ("e", 10)], "e string, t bigint")
    frames = spark.createDataFrame([("e", 3, 0), ("e", 9, 1)], "e string, t bigint, frame bigint")
    assert sorted(tuple(r) for r in align.camera_pointers(ticks, frames, ["e"], "t", "frame", 5).collect()) == [("e", 0, 0), ("e", 10, 1)]


def test_direct_rows(spark):
    spec = {"dataset_source": "s", "ingestion_strategy": "mcap", "tick_fps": 10.0, "camera_keys": [], "state_components": [["/s", 1]], "action_components": [["/a", 1]]}
    messages = spark.createDataFrame([("e", t, k * 10**8, k, [float(k)]) for t in ("/s", "/a") for k in range(4)] + [("f", "/s", 0, 0, [1.0])], "episode_id string, topic string, log_time bigint, seq bigint, value array<double>")
    rows = train.direct_rows(messages, spark.createDataFrame([("e", "fold")], "episode_id string, task string"), schema.build_schema(spec), 2)
    got = sorted((r.frame_index, r.task, r["observation.state"], r.action, r.action_is_pad) for r in rows.collect())
    assert got == [(0, "fold", [0.0], [[0.0], [1.0]], [False, False]), (1, "fold", [1.0], [[1.0], [2.0]], [False, False]), (2, "fold", [2.0], [[2.0], [2.0]], [False, True])]


def test_camera_streams(spark, monkeypatch):
    import sys
    from types import SimpleNamespace

    class Codec:
        """One byte a frame; a frame comes out with the next packet, the last one twice."""

        def __init__(self):
            self.held = None

        def parse(self, data):
            return [data] if data else []

        def decode(self, packet):
            out = [] if self.held is None else [self.held] * (1 if packet else 2)
            self.held = packet
            return [SimpleNamespace(to_ndarray=lambda format, x=x: np.full((2, 2, 3), x[0], np.uint8)) for x in out]

    made = []
    fake = SimpleNamespace(CodecContext=SimpleNamespace(create=lambda name, mode: made.append((name, mode)) or Codec()))
    with monkeypatch.context() as m:
        m.setitem(sys.modules, "av", fake)
        got = [(t, int(x[0, 0, 0])) for t, x in decode.stream_frames([(5, b"\x01", "H265"), (7, b"\x02", None), (9, b"\x03", "")], 9, 2, 2)]
        assert got == [(5, 1), (7, 2), (9, 3), (9, 3)] and made == [("hevc", "r")]
        assert list(decode.stream_frames([], 0, 2, 2)) == []
        with pytest.raises(ValueError, match="vp9"):
            list(decode.stream_frames([(0, b"x", "vp9")], 0, 2, 2))
    frames = spark.createDataFrame([(e, c, k, k, "h264", b"x") for e in (0, 1) for c in ("top", "left") for k in range(3)], "episode_index bigint, camera string, frame bigint, log_time bigint, format string, data binary")
    rows = decode.stream_rows(frames, ["episode_index", "camera"], 2, 2).collect()
    assert sorted((r.episode_index, r.camera) for r in rows if r.error) == [(e, c) for e in (0, 1) for c in ("left", "top")]
    try:
        decode.library("av")
    except decode.MissingDecoder:
        with pytest.raises(decode.MissingDecoder):
            decode.encode_video([np.zeros((2, 2, 3), np.uint8)], 10.0)
