"""Tick grids and alignment of independently timed streams (as-of semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators.ordered import asof, int_bucket

#: Ticks in one stretch of a series.
STRETCH = 8192


def tick_step(fps: float) -> int:
    """ns of a tick, cut to a whole number."""
    if fps <= 0:
        raise ValueError("fps must be positive")
    return int(1e9 / fps)


def tick_grid(spans: DataFrame, step: int, start: str = "start_ns", end: str = "end_ns", name: str = "tick_ns") -> DataFrame:
    """One row per tick in [start, end); spans without length have none. Other columns are kept."""
    if step < 1:
        raise ValueError("step must be at least 1")
    count = F.expr(f"(`{end}` - `{start}` - 1) div {step}")
    stretches = spans.where(F.col(end) > F.col(start)).withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"((`{end}` - `{start}` - 1) div {step}) div {STRETCH}"))))
    ticks = stretches.withColumn("_k", F.explode(F.sequence(F.col("_s") * STRETCH, F.least(count, F.col("_s") * STRETCH + (STRETCH - 1)))))
    return ticks.withColumn(name, F.col(start) + F.col("_k") * F.lit(step)).drop("_s", "_k")


def spans_of(messages: DataFrame, keys: list[str], time: str) -> DataFrame:
    """First and last time over all topics of each episode."""
    return messages.where(F.col(time).isNotNull()).groupBy(*keys).agg(F.min(time).alias("start_ns"), F.max(time).alias("end_ns"))


def floor_align(ticks: DataFrame, messages: DataFrame, keys: list[str], time: str, tie: list[str], value: str, step: int, name: str | None = None) -> DataFrame:
    """The value of each tick: the last message at or before it, before the first message the first."""
    return asof(ticks, messages, keys, time, tie, value, step * STRETCH, name)


def align_topics(messages: DataFrame, key: str, topic: str, time: str, tie: str, value: str, wanted: list[str], step: int) -> DataFrame:
    """One row per episode and tick with the aligned values of all wanted topics as array `vector`, in that order.

    value is a number or an array (arrays are concatenated). Episodes that lack
    one of the topics, or have no length, are left out; see missing_topics().
    Ticks and messages of all topics pass one window per stretch of an episode,
    which keeps the last message of each topic; a stretch hands on one row.
    """
    valid = F.col(topic).isin(wanted) & F.col(time).isNotNull() & F.col(value).isNotNull()
    spans = messages.groupBy(key).agg(F.min(time).alias("start_ns"), F.max(time).alias("end_ns"), F.count_distinct(F.when(valid, F.col(topic))).alias("_n"))
    grid = tick_grid(spans.where(F.col("_n") == len(wanted)).drop("_n"), step, name="_t")
    events = messages.where(valid).select(key, F.col(time).alias("_t"), F.lit(0).alias("_tick"), F.col(tie).alias("_tie"), F.col(topic).alias("_topic"), F.struct(F.col(value).alias("v")).alias("_event"))
    nothing = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ("_tie", "_topic", "_event")]
    both = events.unionByName(grid.select(key, "_t", F.lit(1).alias("_tick"), *nothing)).withColumn("_part", F.struct(F.col(key).alias("k"), int_bucket(F.col("_t"), step * STRETCH).alias("b")))
    inside = W.partitionBy("_part").orderBy("_t", "_tick", "_tie").rowsBetween(W.unboundedPreceding, 0)
    of = [F.when(F.col("_topic") == w, F.col("_event")) for w in wanted]
    local = both.select("_part", "_t", "_tick", *(F.last(x, ignorenulls=True).over(inside).alias(f"_now{i}") for i, x in enumerate(of)))
    place = [F.when(F.col("_topic") == w, F.struct("_t", "_tie")) for w in wanted]
    ends = both.groupBy("_part").agg(*(f("_event", p).alias(f"{name}{i}") for i, p in enumerate(place) for name, f in (("_last", F.max_by), ("_first", F.min_by))))
    series = W.partitionBy("_part.k").orderBy("_part.b")
    earlier, later = series.rowsBetween(W.unboundedPreceding, -1), series.rowsBetween(0, W.unboundedFollowing)
    handed = ends.select(
        "_part", *(F.coalesce(F.last(f"_last{i}", ignorenulls=True).over(earlier), F.first(f"_first{i}", ignorenulls=True).over(later)).alias(f"_other{i}") for i in range(len(wanted)))
    )
    found = [F.coalesce(f"_now{i}", f"_other{i}")["v"] for i in range(len(wanted))]
    parts = found if dict(messages.dtypes)[value].startswith("array") else [F.array(x) for x in found]
    return local.where("_tick = 1").join(handed, "_part").select(F.col("_part.k").alias(key), F.col("_t").alias("tick_ns"), F.concat(*parts).alias("vector"))


def missing_topics(messages: DataFrame, key: str, topic: str, wanted: list[str]) -> DataFrame:
    """The reject table: each episode and wanted topic that has no message."""
    seen = messages.where(F.col(topic).isin(wanted)).select(key, topic).distinct()
    need = messages.select(key).distinct().withColumn(topic, F.explode(F.array(*(F.lit(w) for w in wanted))))
    return need.join(seen, [key, topic], "left_anti")


def first_seen(messages: DataFrame, key: str, topic: str, seq: str, candidates: list[str]) -> DataFrame:
    """Per episode the candidate topic that comes first in read order (key, topic)."""
    return messages.where(F.col(topic).isin(candidates)).groupBy(key).agg(F.min_by(topic, seq).alias(topic))


def lock_topic(messages: DataFrame, key: str, topic: str, seq: str, candidates: list[str]) -> DataFrame:
    """Messages without those of candidate topics other than the first seen one."""
    lock = first_seen(messages, key, topic, seq, candidates).withColumnRenamed(topic, "_lock")
    kept = messages.join(lock, key, "left")
    return kept.where(~F.col(topic).isin(candidates) | (F.col(topic) == F.col("_lock"))).drop("_lock")


def fifo_pair(frames: DataFrame, times: DataFrame, keys: list[str], position: str, time: str) -> DataFrame:
    """Decoded frames paired with message times by position; frames beyond the last message take its time."""
    last = times.groupBy(*keys).agg(F.max(time).alias("_last"))
    paired = frames.join(times.select(*keys, position, time), [*keys, position], "left").join(last, keys, "left")
    return paired.withColumn(time, F.coalesce(time, "_last")).drop("_last")


def camera_pointers(ticks: DataFrame, frames: DataFrame, keys: list[str], time: str, frame: str, step: int) -> DataFrame:
    """For each tick the number of the camera frame that shows it; pixels are joined by number afterwards."""
    return floor_align(ticks, frames, keys, time, [frame], frame, step)
