"""Catalogues of paths, tasks and shards, and the selection of episodes from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.scalars import shard_range, split_and_task
from tickloom.operators.ordered import int_bucket, numbered
from tickloom.runtime import lookup_join


def task_catalog(listing: DataFrame, path: str = "path", suffix: str = "", prefix: str = "data") -> DataFrame:
    """The listed episode files with their split and task. Paths of another shape are 'unknown'; null paths are dropped."""
    named = listing.where(F.col(path).isNotNull() & F.endswith(F.col(path), F.lit(suffix))).withColumn("_s", split_and_task(F.col(path), prefix))
    return named.select(*listing.columns, F.col("_s.split").alias("split"), F.col("_s.task").alias("path_task"))


def task_counts(df: DataFrame, task: str) -> DataFrame:
    """Rows per task, most first, then by name."""
    return df.groupBy(task).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(task))


def paths_by_task(catalog: DataFrame, task: str, path: str, position: str, bucket: int = 65_536) -> DataFrame:
    """The paths of each task numbered in listing order: task, k, path. position is a whole number.

    Rows, not a list per task: one task may hold a third of all paths.
    """
    ordered = numbered(catalog.select(task, path, position), [task], [position, path], int_bucket(F.col(position), bucket), "k")
    return ordered.select(task, "k", path)


def match_tasks(tasks: DataFrame, requested: list[str], task: str, position: str) -> DataFrame:
    """For each requested name the first task, in listing order, that contains it: requested, task, n_matches.

    A request without a match stays, with a null task and 0; check_matches() makes that an error.
    """
    wanted = tasks.sparkSession.createDataFrame([(i, r) for i, r in enumerate(dict.fromkeys(requested))], "request_order int, requested string")
    each = tasks.groupBy(task).agg(F.min(position).alias("_first"))
    pairs = each.join(F.broadcast(wanted), F.contains(each[task], wanted["requested"]))
    found = pairs.groupBy("request_order", "requested").agg(F.min_by(task, F.struct("_first", task)).alias(task), F.count("*").alias("n_matches"))
    return wanted.join(found.drop("request_order"), "requested", "left").select("request_order", "requested", task, F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"))


def check_matches(matches: DataFrame) -> None:
    missing = [r.requested for r in matches.where("n_matches = 0").select("requested").limit(20).collect()]
    if missing:
        raise ValueError(f"no task contains {missing}")


def first_n(df: DataFrame, keys: list[str], order: list, n: int, name: str = "place") -> DataFrame:
    """The first n rows of each key; with few n the window keeps n rows a partition before the shuffle."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)


def select_episodes(catalog: DataFrame, requested: list[str], task: str, position: str, cap: int) -> DataFrame:
    """The first cap episodes of the task that each request names, in listing order."""
    chosen = match_tasks(catalog, requested, task, position).where(F.col(task).isNotNull()).groupBy(task).agg(F.min("request_order").alias("request_order"), F.min_by("requested", "request_order").alias("requested"))
    return first_n(catalog.join(F.broadcast(chosen), task), [task], [position], cap)


def shards(listing: DataFrame, path: str, position: str) -> DataFrame:
    """Shards named '<lo>-<hi>.tar': position, path, lo, hi. Other names are not shards."""
    return listing.withColumn("_r", shard_range(F.col(path))).where("_r is not null").select(position, path, "_r.lo", "_r.hi")


def resolve_shards(ids: DataFrame, shard_table: DataFrame, id_name: str, path: str, position: str, width: int = 1024, require_all: bool = False) -> DataFrame:
    """Each id with the first shard, in listing order, whose lo..hi holds it (inclusive).

    Ranges are cut at multiples of width, so the range join is an equi join on
    the stretch; it needs no nested loop. Uncovered ids get a null path, or
    raise if require_all.
    """
    cut = shard_table.where("lo <= hi").withColumn("_w", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"hi div {width}"))))
    keyed = ids.where(F.col(id_name).isNotNull()).select(id_name).distinct().withColumn("_w", F.expr(f"`{id_name}` div {width}"))
    pairs = lookup_join(keyed, cut.select("_w", "lo", "hi", path, position), "_w").where(F.col(id_name).between(F.col("lo"), F.col("hi")))
    best = pairs.groupBy(id_name).agg(F.min_by(path, position).alias(path))
    out = keyed.drop("_w").join(best, id_name, "left")
    return out.withColumn(path, F.coalesce(path, F.raise_error(F.concat(F.lit("no shard holds id "), F.col(id_name).cast("string"))))) if require_all else out


def complete_episodes(parts: DataFrame, episode: str, part: str, required: list[str]) -> DataFrame:
    """Episodes that have every required part."""
    return parts.where(F.col(part).isin(required)).groupBy(episode).agg(F.count_distinct(part).alias("_n")).where(F.col("_n") == len(required)).select(episode)


def agreeing_lengths(a: DataFrame, b: DataFrame, episode: str) -> DataFrame:
    """Episodes with equally many rows in both tables, and their length; others are rejected."""
    left, right = (x.groupBy(episode).agg(F.count("*").alias(n)) for x, n in ((a, "n_a"), (b, "n_b")))
    return left.join(right, episode).where("n_a = n_b").select(episode, F.col("n_a").alias("length"))


def clip(frames: DataFrame, keys: list[str], time: str, order: list, from_time, n: int, length: str | None = None) -> DataFrame:
    """The first min(n, length) frames at or after from_time; frames without a time count as after it."""
    later = frames.where(F.col(time).isNull() | (F.col(time) >= from_time))
    out = first_n(later, keys, order, n)
    return out if length is None else out.where(F.col("place") <= F.col(length))


def first_shapes(records: DataFrame, order: str, shapes: str = "depth_shapes") -> DataFrame:
    """camera and the shape of the first record that gives one; cameras without any are absent."""
    each = records.where(F.col(shapes).isNotNull()).select(F.col(order).alias("_o"), F.explode(shapes).alias("camera", "shape"))
    return each.where("shape is not null").groupBy("camera").agg(F.min_by("shape", "_o").alias("shape"))
