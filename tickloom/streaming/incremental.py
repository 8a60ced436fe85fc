"""Streaming forms: incremental planning of arriving episodes, and metrics by event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import planner
from tickloom.operators.ordered import int_bucket, numbered


def plan_stream(listing: DataFrame, manifest_path: str, checkpoint: str, convert: Callable[[DataFrame], DataFrame] | None = None, key: str = "rel_path", task: str = "task", order: str = "listing_pos") -> StreamingQuery:
    """Give every newly listed episode a stable episode_index and task_index in the manifest at manifest_path.

    Each micro-batch is compared with the manifest; episodes that it already has
    are passed over, so a repeated batch adds nothing. convert takes the new rows
    and returns those that succeeded; their numbers have no gaps.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        try:
            manifest = spark.read.parquet(manifest_path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            manifest = spark.createDataFrame([], f"`{key}` string, `{task}` string, episode_index bigint, task_index bigint, batch bigint")
        fresh = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(task, order).alias(task), F.min(order).alias(order))
        plan = planner.plan(fresh, manifest, key, task, "episode_index")
        done = plan.to_convert if convert is None else convert(plan.to_convert)
        placed = numbered(done, [], [order, key], int_bucket(F.col(order)), "_p").crossJoin(F.broadcast(plan.next_episode_index))
        added = placed.join(plan.task_index.select(task, "task_index"), task).select(key, task, (F.col("next_index") + F.col("_p")).alias("episode_index"), "task_index", F.lit(number).cast("bigint").alias("batch"))
        added.write.mode("append").parquet(manifest_path)

    return listing.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, keys: list[str], value: str, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Count, sum and mean per key and event-time window; rows later than `late` are dropped once their window is closed."""
    span = F.window(time, size, slide) if slide else F.window(time, size)
    out = events.withWatermark(time, late).groupBy(span.alias("w"), *keys).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total", "mean")


def sessions(events: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Stretches of activity per key that no gap interrupts."""
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
