"""Irregular readings onto a regular grid.

The increments between consecutive readings are spread over the grid cells
(ticks) they overlap, in proportion to the overlap. For cumulative counters a
fall is a reset: the counter began again at zero. For levels (positions,
temperatures) the increments are signed, and their running total at a cell
border is the level interpolated there. Cells without a reading are marked.

Readings are shuffled once, by block of their series; what one block needs of
the one before it is a single row. The rest is one union and one grouped sum, so
partial aggregation applies and no series has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.runtime import lookup_join, materialize

#: Ticks in one block: a series is differenced block by block.
BLOCK = 4096


def recording_spans(recordings: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per recording: episode_id, start_ns, end_ns and step, the ns of a tick.

    Repeated rows collapse; recordings without times, or of a source without a
    positive tick_fps, have no grid and are left out.
    """
    fps = schemas.where(F.col("tick_fps") > 0).groupBy("dataset_source").agg(F.max("tick_fps").alias("tick_fps"))
    spans = (
        recordings.where(F.col("episode_id").isNotNull() & (F.col("end_ns") > F.col("start_ns")))
        .groupBy("episode_id")
        .agg(F.min(F.struct("start_ns", "end_ns", "dataset_source")).alias("r"))
        .select("episode_id", "r.start_ns", "r.end_ns", "r.dataset_source")
    )
    return lookup_join(spans, fps, "dataset_source").select(
        "episode_id", "start_ns", "end_ns", F.greatest(F.lit(1), (F.lit(1e9) / F.col("tick_fps")).cast("bigint")).cast("bigint").alias("step")
    )


def readings(messages: DataFrame, spans: DataFrame, payload: str = "value", size_of: DataFrame | None = None) -> DataFrame:
    """Messages that are readings: payload neither null nor empty, log_time in [start_ns, end_ns) of the recording.

    size_of: the recordings that the spans come from.
    """
    filled = F.size(payload) > 0 if dict(messages.dtypes)[payload].startswith("array") else F.col(payload).isNotNull()
    sent = messages.where(F.col(payload).isNotNull() & filled & F.col("log_time").isNotNull())
    return lookup_join(sent, spans, "episode_id", size_of=size_of).where("log_time >= start_ns and log_time < end_ns")


def _explode_ticks(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per tick from first to last, by way of blocks, so that no long array is built."""
    blocks = df.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    blocks = blocks.withColumn("_block", F.explode(F.expr(f"sequence(_first div {BLOCK}, _last div {BLOCK})")))
    inside = F.sequence(F.greatest("_first", F.col("_block") * BLOCK), F.least("_last", F.col("_block") * BLOCK + (BLOCK - 1)))
    return blocks.withColumn("tick", F.explode(inside)).drop("_first", "_last", "_block")


def _numbers(column: str, width: int) -> list[Column]:
    """The elements of an array as columns: sums of them stay in the hash aggregate, where arrays would need a sort."""
    return [F.get(column, F.lit(i)) for i in range(width)]


def _vector(parts: str, width: int) -> Column:
    return F.slice(F.array(*(F.col(f"{parts}_{i}") for i in range(width))), F.lit(1), F.col("dim"))


def distinct_readings(read: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Readings once each, with `before`: log_time and value of the usable reading before it in its block.

    A vector of more than width numbers is none that the source sends: it stays a
    reading with dim 0 and an empty value, and no other looks back on it.
    Blocks of a series are placed first; removing repeats and looking back both
    work within them, so the readings are shuffled once.
    """
    placed = read.withColumn("tick", F.expr("(log_time - start_ns) div step")).withColumn("block", F.expr(f"tick div {BLOCK}")).withColumn("seq", F.coalesce("seq", F.lit(-1)))
    fits = F.size("value") <= width
    once = (
        placed.repartition(*keys, "block")
        .groupBy(*keys, "block", "tick", "log_time", "seq", "start_ns", "end_ns", "step")
        .agg(F.max(F.when(fits, F.size("value")).otherwise(0)).alias("dim"), *(F.max(F.when(fits, x)).alias(f"value_{i}") for i, x in enumerate(_numbers("value", width))))
        .withColumn("value", _vector("value", width))
        .drop(*(f"value_{i}" for i in range(width)))
    )
    earlier = W.partitionBy(*keys, "block").orderBy("log_time", "seq").rowsBetween(W.unboundedPreceding, -1)
    return once.withColumn("before", F.when(F.col("dim") > 0, F.last(F.when(F.col("dim") > 0, F.struct("log_time", "value")), ignorenulls=True).over(earlier)))


def look_back(read: DataFrame, keys: list[str]) -> DataFrame:
    """Fill `before` of each block's first usable reading from the last one of the blocks before it."""
    place = F.when(F.col("dim") > 0, F.struct("log_time", "seq"))
    last = read.groupBy(*keys, "block").agg(F.max_by(F.struct("log_time", "value"), place).alias("_last"))
    earlier = W.partitionBy(*keys).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    handed = last.select(*keys, "block", F.last("_last", ignorenulls=True).over(earlier).alias("_handed"))
    return read.join(handed, [*keys, "block"]).withColumn("before", F.coalesce("before", F.when(F.col("dim") > 0, F.col("_handed")))).drop("_handed")


def widest(schemas: DataFrame, messages: DataFrame) -> int:
    """The widest component of all schemas; where they declare none, the longest vector of the messages."""
    if {"state_components", "action_components"} <= set(schemas.columns):
        dims = schemas.select(F.explode(F.concat("state_components", "action_components")).alias("c")).agg(F.max("c.dim")).first()[0]
        if dims:
            return dims
    return max(1, messages.agg(F.max(F.size("value"))).first()[0] or 1)


def regular_grid(messages: DataFrame, recordings: DataFrame, schemas: DataFrame, kind: str = "level", width: int | None = None) -> DataFrame:
    """One row per recording, topic and tick of the source's tick_fps.

    Columns: episode_id, topic, tick, n_readings, missing (no reading in the
    tick), value (interpolated at the beginning of the tick; before the first
    reading the first, after the last the last), increment (change during the
    tick, null where nothing covers it), covered (share of the tick between two
    readings), resets (counters that began again), n_unusable (readings in the
    tick whose vector is longer than any the sources send).

    kind is 'level' or 'counter'. width is the number of vector components kept
    apart, if not given that of the widest schema component or, without such, of
    the longest vector there is. A longer vector is a reading, but its numbers
    belong to no component: the grid goes on as if they were not there. Topics without a reading in a recording have no grid. Repeated
    messages count once; of messages with the same log_time and seq the greatest
    numbers hold. Null or empty value and null log_time are no readings; a
    component that is null in a reading takes no part in the increments on both
    sides of it, one that is NaN makes them NaN. Extra columns are ignored.
    """
    if kind not in ("level", "counter"):
        raise ValueError(f"kind must be 'level' or 'counter', not {kind!r}")
    keys = ["episode_id", "topic"]
    sent = messages.where(F.col("topic").isNotNull()).select(*keys, "log_time", "seq", F.col("value").cast("array<double>").alias("value"))
    width = width or widest(schemas, sent)
    # three passes read it: kept in the shared folder, so that messages are shuffled once
    read = materialize(distinct_readings(readings(sent, recording_spans(recordings, schemas), size_of=recordings), keys, width), "readings")

    # the grid itself
    usable = F.col("dim") > 0
    place = F.when(usable, F.struct("log_time", "seq"))
    series = read.groupBy(*keys, "start_ns", "end_ns", "step").agg(
        F.min_by("value", place).alias("first_value"), F.max_by("value", place).alias("last_value"), F.min(F.when(usable, F.col("log_time"))).alias("first_time"), F.max("dim").alias("dim")
    )
    nothing = F.lit(None).cast("array<double>")
    grid = _explode_ticks(series, F.lit(0).cast("bigint"), F.expr("(end_ns - start_ns - 1) div step")).select(
        *keys, "tick", F.lit(0).alias("n"), F.lit(0).alias("odd"), F.lit(0).alias("reset"), F.lit(0.0).alias("share"), nothing.alias("part"), nothing.alias("at_start"), "dim",
        F.when(F.expr("start_ns + tick * step <= first_time"), F.col("first_value")).otherwise(F.col("last_value")).alias("edge"),
    )

    # each reading: a mark in its tick, and its increment over the ticks since the reading before
    fell = lambda a, b: (b < a) if kind == "counter" else F.lit(False)
    moves = look_back(read, keys).select(
        *keys, "start_ns", "step", "dim", F.coalesce("before.log_time", "log_time").alias("t0"), F.col("log_time").alias("t1"), "before.value", F.col("tick").alias("own"),
        F.zip_with("before.value", "value", lambda a, b: F.when(fell(a, b), b).otherwise(b - a)).alias("delta"),
        F.coalesce(F.exists(F.zip_with("before.value", "value", lambda a, b: F.coalesce(fell(a, b), F.lit(False))), lambda x: x), F.lit(False)).alias("fell"),
    ).withColumnRenamed("value", "v0")
    cells = _explode_ticks(moves, F.expr("(t0 - start_ns) div step"), F.col("own"))
    cells = (
        cells.withColumn("c0", F.expr("start_ns + tick * step"))
        .withColumn("overlap", F.greatest(F.lit(0), F.least("t1", F.expr("c0 + step")) - F.greatest("t0", "c0")))
        .withColumn("ratio", F.try_divide(F.col("overlap").cast("double"), F.col("t1") - F.col("t0")))
        .withColumn("so_far", F.try_divide((F.col("c0") - F.col("t0")).cast("double"), F.col("t1") - F.col("t0")))
    )
    # a fall of a counter has no level between its ends; the reading before it holds on
    level = F.transform(F.arrays_zip("v0", "delta"), lambda z: z["v0"] + F.when(F.col("fell"), F.lit(0.0)).otherwise(z["delta"]) * F.col("so_far"))
    own = F.col("own") == F.col("tick")
    spread = cells.select(
        *keys, "tick", own.cast("int").alias("n"), (own & ~usable).cast("int").alias("odd"), (F.col("fell") & own).cast("int").alias("reset"), (F.col("overlap") / F.col("step")).alias("share"),
        F.transform("delta", lambda d: d * F.col("ratio")).alias("part"), F.when((F.col("c0") >= F.col("t0")) & (F.col("c0") < F.col("t1")), level).alias("at_start"), "dim", nothing.alias("edge"),
    )
    summed = grid.unionByName(spread).groupBy(*keys, "tick").agg(
        F.sum("n").alias("n_readings"), F.sum("odd").alias("n_unusable"), F.sum("reset").alias("resets"), F.sum("share").alias("covered"), F.max("dim").alias("dim"),
        *(F.sum(x).alias(f"{name}_{i}") for name in ("part", "at_start", "edge") for i, x in enumerate(_numbers(name, width))),
    )
    # at most one span begins before and ends after the start of a tick, so each of these sums has one term
    value = F.transform(F.arrays_zip(_vector("at_start", width).alias("s"), _vector("edge", width).alias("e")), lambda z: F.coalesce(z["s"], z["e"]))
    return summed.select(
        *keys, "tick", "n_readings", (F.col("n_readings") == 0).alias("missing"), value.alias("value"),
        F.when(F.col("covered") > 0, _vector("part", width)).alias("increment"), F.least(F.lit(1.0), "covered").alias("covered"), "resets", "n_unusable",
    )
