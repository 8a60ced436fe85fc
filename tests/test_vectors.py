from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators import actions, images

STATE = (("c", 2), ("a", 1), ("wide", 3))
ACTION = (("a", 1), ("b", 2), ("c", 2), ("wide", 2))


def test_positions_and_plan():
    assert actions.offsets(ACTION)["c"] == (3, 2)
    assert actions.positions(ACTION, [("c", 2), ("a", 1)]) == [3, 4, 0]
    assert actions.state_positions(ACTION, STATE, exclude=["a"]) == [None, None, None, 0, 1, None, None]


def test_relative_chunk_subtracts_the_anchor_state(spark):
    at = actions.state_positions((("a", 1), ("b", 1)), (("x", 1), ("a", 1)))
    df = spark.createDataFrame([([[1.0, 5.0], [4.0, 6.0], None], [9.0, 0.5])], "chunk array<array<double>>, state array<double>")
    assert df.select(actions.relative_chunk(F.col("chunk"), F.col("state"), at)).first()[0] == [[0.5, 5.0], [3.5, 6.0], None]


def test_select_actions_no_op_and_nulls(spark):
    df = spark.createDataFrame([([[1.0, 2.0, 3.0]],), (None,)], "`a.x` array<array<double>>")
    assert actions.select_actions(df, "a.x", [0, 1, 2], 3) is df
    assert [r[0] for r in actions.select_actions(df, "a.x", [2, 0], 3).collect()] == [[[3.0, 1.0]], None]


def test_layout_matches_numpy(spark):
    x = np.arange(24.0).reshape(2, 4, 3)
    df = spark.createDataFrame([([float(v) for v in x.ravel()],)], "v array<double>")
    r = df.select(images.reshape(F.col("v"), 2, 4, 3).alias("r"), images.hwc_to_chw(F.col("v"), 2, 4, 3).alias("c"), images.replicate_channels(F.col("v"), 1).alias("three"), images.replicate_channels(F.col("v"), 3).alias("one")).first()
    assert np.array_equal(np.array(r.r), x)
    assert np.array_equal(np.array(r.c), x.transpose(2, 0, 1).ravel())
    assert len(r.three) == 72 and len(r.one) == 24


def test_modes(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (100.0,), (300.0,)], "x double")
    x = np.array([-5.0, 0, 100, 300])
    get = lambda *a, **k: [r[0] for r in df.select(images.normalized(F.col("x"), *a, **k)).collect()]
    assert np.allclose(get("unit01"), x / 255) and np.allclose(get("unit_pm1"), x / 127.5 - 1)
    assert np.allclose(get("depth", limit=200), np.clip(x, 0, 200) / 200)
    assert np.allclose(get("log", limit=200), np.log1p(np.maximum(x, 0)) / np.log1p(200)) and get("log", limit=200)[-1] > 1
    assert np.allclose(get("mean_std", 10.0, 2.0), (x - 10) / 2)
    assert get("mean_std", 10.0, 0.0) == [None] * 4
    assert all(v is not None for v in get("mean_std", 10.0, 0.0, eps=1e-6))
    for bad in ("depth", "log", "other"):
        with pytest.raises(ValueError):
            images.normalized(F.col("x"), bad)


def test_normalize_columns(spark):
    df = spark.createDataFrame([([0.0, 255.0, 10.0, 20.0], [50.0], 1)], "`observation.images.top` array<double>, `observation.images.depth_head` array<double>, task int")
    out = images.normalize_columns(df, {"depth_head": "depth"}, "unit01", max_values={"depth_head": 100.0}).first()
    assert out[0][1] == 1.0 and out[1] == [0.5] and out[2] == 1
    stats = {"top": ([5.0, 10.0], [1.0, 0.0]), "depth_head": ([0.0], [50.0])}
    out = images.normalize_columns(df, {}, "mean_std", stats=stats).first()
    assert out[0] == [-5.0, 250.0, None, None] and out[1] == [1.0]
    for limit in ({}, {"depth_head": 0.0}):
        with pytest.raises(ValueError):
            images.normalize_columns(df, {"depth_head": "log"}, "unit01", max_values=limit)


def test_schemas(spark, sf_dir, tmp_path):
    names = schema.available_sources()
    assert "twinbench" in names
    table = schema.schemas_of(spark.read.parquet(f"{sf_dir}/robot_schemas.parquet"))
    for n in names:
        s = schema.load_schema(n)
        assert (s.state_dim, s.action_dim, s.tick_fps, s.camera_keys) == (table[n].state_dim, table[n].action_dim, table[n].tick_fps, table[n].camera_keys)
    s = schema.load_schema("twinbench")
    arm = s.select_action_space("arm")
    assert arm.action_dim == 12 and s.action_positions(arm) == [*range(6), *range(7, 13)] and s.step_ns == 33_333_333
    assert s.select_action_space(None) is s
    with pytest.raises(ValueError, match="arm"):
        s.select_action_space("leg")
    (tmp_path / "x.yaml").write_text("dataset_source: y\n")
    for source in ("x", "none"):
        with pytest.raises(ValueError):
            schema.load_schema(source, tmp_path)
    with pytest.raises(ValueError, match="tick_fps"):
        schema.build_schema({"dataset_source": "x"})
    p = schema.conversion_params(s, ["b", "a"], 3, (8, 8))
    assert p == schema.conversion_params(s, ["a", "b"], 3, (8, 8))
