"""Incremental conversion: what to convert, what to keep, and stable gapless numbers.

The planner compares a request with the manifest. The gate decides whether the
manifest may be used at all: every field of the fingerprint must be equal,
except the task list and the cap on episodes, which are the planner's business.
With strict=True all fields must be equal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.ordered import numbered, ranged, running, spread_bucket

PLANNED_FIELDS = ("tasks", "max_episodes_per_task")


def may_reuse(stored: dict | None, requested: dict, strict: bool = False) -> bool:
    """Whether converted episodes of the stored fingerprint serve the requested one."""
    if stored is None:
        return False
    skip = () if strict else PLANNED_FIELDS
    keys = (stored.keys() | requested.keys()) - set(skip)
    return all(stored.get(k) == requested.get(k) for k in keys)


@dataclass
class Plan:
    """reused and to_convert together are the request; removed are manifest rows that it no longer names."""

    reused: DataFrame
    to_convert: DataFrame
    removed: DataFrame
    task_index: DataFrame
    next_episode_index: DataFrame


def next_index(df: DataFrame, column: str) -> DataFrame:
    """One row: the index after the greatest one, 0 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(-1)) + 1).cast("bigint").alias("next_index"))


def extend_task_index(known: DataFrame, tasks: DataFrame, task: str = "task", index: str = "task_index") -> DataFrame:
    """task, task_index and is_new: known tasks keep their index, new ones follow in sorted order."""
    new = tasks.where(F.col(task).isNotNull()).select(task).distinct().join(known, task, "left_anti")
    placed = numbered(ranged(new, [task]), [], [task], F.col("_bucket"), "_p").crossJoin(F.broadcast(next_index(known, index)))
    added = placed.select(task, (F.col("next_index") + F.col("_p")).alias(index), F.lit(True).alias("is_new"))
    return known.select(task, F.col(index).cast("bigint").alias(index), F.lit(False).alias("is_new")).unionByName(added)


def plan(requested: DataFrame, manifest: DataFrame, key: str, task: str, index: str, reuse: bool = True) -> Plan:
    """Compare a request (key, task, ...) with a manifest (key, task, index, ...), both with one row per key.

    If the request no longer names an episode that was converted, or reuse is
    False, everything is converted anew.
    """
    kept = manifest if reuse else manifest.limit(0)
    removed = kept.join(requested, key, "left_anti")
    known = kept.where(F.col("task_index").isNotNull()).groupBy(task).agg(F.min("task_index").alias("task_index")) if "task_index" in kept.columns else kept.limit(0).select(task, F.lit(0).cast("bigint").alias("task_index"))
    return Plan(
        requested.join(kept.select(key, index), key), requested.join(kept, key, "left_anti"), removed,
        extend_task_index(known, requested.select(task), task), next_index(kept, index),
    )


def compact(survivors: DataFrame, order: str, start: int | DataFrame = 0, name: str = "new_index") -> DataFrame:
    """Surviving episodes renumbered without gaps from start, in order of their old integer number."""
    out = numbered(survivors, [], [order], spread_bucket(survivors, order), name)
    if isinstance(start, DataFrame):
        return out.crossJoin(F.broadcast(start)).withColumn(name, F.col(name) + F.col("next_index")).drop("next_index")
    return out.withColumn(name, F.col(name) + F.lit(start))


def with_offsets(episodes: DataFrame, index: str = "episode_index", length: str = "length") -> DataFrame:
    """Add `offset`, the rows of all episodes before this one. A null length counts 0."""
    return running(episodes, [], [index], spread_bucket(episodes, index), "offset", F.coalesce(F.col(length), F.lit(0)).cast("bigint"))


def global_index(frames: DataFrame, offsets: DataFrame, index: str = "episode_index") -> DataFrame:
    """Set `index` from frame_index and the episode's offset; never from an older `index`, which may hold an offset already."""
    return frames.drop("index").join(offsets.select(index, "offset"), index).withColumn("index", F.col("offset") + F.col("frame_index")).drop("offset")


def renumber(frames: DataFrame, mapping: DataFrame, old: str = "episode_index", new: str = "new_index") -> DataFrame:
    """Give frames the new numbers of their episodes; frames of episodes that are not in the mapping are dropped."""
    return frames.join(mapping.select(F.col(old), F.col(new)), old).drop(old).withColumnRenamed(new, old)


def merge_manifest(reused: DataFrame, converted: DataFrame) -> DataFrame:
    """The new manifest: reused rows and the converted ones."""
    return reused.unionByName(converted, allowMissingColumns=True)


def missing_tasks(used: DataFrame, tasks: DataFrame, index: str = "task_index") -> DataFrame:
    """Task numbers in use that the tasks table lacks; must be empty."""
    return used.select(index).distinct().join(tasks, index, "left_anti")
