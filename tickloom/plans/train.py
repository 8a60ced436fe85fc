"""The training data of a dataset: chunk, action space, relative actions, split, statistics, normalisation.

One lazy chain; Catalyst prunes columns, and the split predicate, which uses the
episode alone, runs before the chunks are built.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import actions, split, stats
from tickloom.schema import RobotSchema
from tickloom.operators.chunk import action_chunks
from tickloom.sources.root import CAMERA_FRAME, read_training_rows


@dataclass
class TrainRequest:
    root: str
    chunk_size: int = 50
    action_space: str | None = None
    relative: bool = False
    relative_exclude: tuple[str, ...] = ()
    val_fraction: float = 0.0
    test_fraction: float = 0.0
    seed: int = 0
    stats_rows: int | None = 500
    image_modes: dict[str, str] = field(default_factory=dict)


def training_rows(spark: SparkSession, schema: RobotSchema, request: TrainRequest, side: str = "train") -> DataFrame:
    """Rows of one side of the split, with selected and, if asked for, relative actions."""
    chosen = schema.select_action_space(request.action_space)
    rows = read_training_rows(spark, request.root, request.chunk_size, schema.depth_camera_keys)
    if request.val_fraction or request.test_fraction:
        rows = split.only_split(rows, "episode_index", side, request.val_fraction, request.test_fraction, request.seed)
    rows = actions.select_actions(rows, "action", schema.action_positions(chosen), schema.action_dim)
    if request.relative:
        at = actions.state_positions(chosen.action_components, chosen.state_components, request.relative_exclude)
        rows = rows.withColumn("action", actions.relative_chunk(F.col("action"), F.col("`observation.state`"), at))
    return rows


def dataset_stats(rows: DataFrame, n: int | None = 500) -> dict[str, DataFrame]:
    """Mean and standard deviation of state and valid actions, over the first n rows by index or all."""
    sample = stats.head(rows, "index", n)
    chunks = sample.select(F.col("action").alias("chunk"), F.col("action_is_pad").alias("is_pad"))
    return {"observation.state": stats.vector_stats(sample, "observation.state"), "action": stats.valid_action_stats(chunks)}


def check_side_schema(main: RobotSchema, side: RobotSchema) -> list[str]:
    """Warnings of a side dataset; fields that change the rows must agree."""
    for name in ("camera_keys", "depth_camera_keys", "state_components", "action_components"):
        if getattr(main, name) != getattr(side, name):
            raise ValueError(f"{name} differs: {getattr(main, name)} and {getattr(side, name)}")
    return [] if main.tick_fps == side.tick_fps else [f"tick_fps differs: {main.tick_fps} and {side.tick_fps}"]


def unknown_cameras(modes: dict[str, str], schema: RobotSchema) -> set[str]:
    return set(modes) - set(schema.camera_keys) - {f"depth_{c}" for c in schema.depth_camera_keys}


def direct_rows(messages: DataFrame, tasks: DataFrame, schema: RobotSchema, chunk_size: int) -> DataFrame:
    """Training rows straight from raw messages, without a dataset on disk: task, observation.state, action, action_is_pad and the numbers of the camera frames.

    tasks: episode_id and task. Episodes that lack a topic or camera give no rows.
    """
    from tickloom.plans.prepare import aligned_frames

    rows = action_chunks(aligned_frames(messages, schema), ["episode_id"], "frame_index", "action", chunk_size)
    named = rows.join(tasks.select("episode_id", "task"), "episode_id", "left")
    return named.select("episode_id", "frame_index", "task", "`observation.state`", F.col("chunk").alias("action"), F.col("is_pad").alias("action_is_pad"), *(f"`{c}`" for c in named.columns if c.startswith(CAMERA_FRAME)))
