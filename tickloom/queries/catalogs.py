"""Catalogues, selection, shards, planning and numbering over manifest, recordings, orders, part and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import catalog, planner
from tickloom.operators.ordered import int_bucket, numbered
from tickloom.queries.tables import table

REQUESTS = ["fold", "plug", "no such task", "slide"]


def _listing(spark, sf_dir) -> DataFrame:
    """The listed paths of all converted episodes; the smallest episode_index is the place in the listing."""
    rows = table(spark, sf_dir, "manifest").where("rel_path is not null").groupBy(F.col("rel_path").alias("path")).agg(F.min("episode_index").alias("listing_pos"))
    return catalog.task_catalog(rows, "path", ".mcap")


def task_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(spark, sf_dir)


def task_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.task_counts(_listing(spark, sf_dir), "path_task")


def paths_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.paths_by_task(_listing(spark, sf_dir), "path_task", "path", "listing_pos")


def match_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.match_tasks(_listing(spark, sf_dir), REQUESTS, "path_task", "listing_pos").select("requested", "path_task", "n_matches")


def select_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = catalog.select_episodes(_listing(spark, sf_dir), REQUESTS, "path_task", "listing_pos", 5)
    return chosen.select("requested", "path_task", "path", F.col("place").cast("bigint").alias("place"))


def numeric_order_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids kept as text, the first ten of each status in numeric order."""
    ids = table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("episode_id")).distinct()
    kept = catalog.first_n(ids, ["o_orderstatus"], [F.col("episode_id").cast("bigint")], 10)
    return kept.select("o_orderstatus", "episode_id", F.col("place").cast("bigint").alias("place"))


def _shards(spark, sf_dir) -> DataFrame:
    """Shard files of 37 ids, one for each supplier, listed backwards; every other range overlaps the one before."""
    s = F.col("s_suppkey")
    lo, hi = s * 20, s * 20 + 36
    listing = table(spark, sf_dir, "supplier").select((-s).alias("listing_pos"), F.concat(F.lit("observations/7/"), lo.cast("string"), F.lit("-"), hi.cast("string"), F.lit(".tar")).alias("path"))
    return catalog.shards(listing, "path", "listing_pos")


def shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shards(spark, sf_dir).select("path", "lo", "hi")


def shard_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolve_shards(table(spark, sf_dir, "part"), _shards(spark, sf_dir), "p_partkey", "path", "listing_pos")


def _plan(spark, sf_dir) -> planner.Plan:
    """Orders that are open or in progress are asked for; open and finished ones were converted before."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rel_path"), F.col("o_orderpriority").alias("task"), "o_orderstatus")
    done = numbered(orders.where("o_orderstatus in ('O', 'F')"), [], ["rel_path"], int_bucket(F.col("rel_path")), "episode_index")
    index = F.ascii("task").cast("bigint") - F.ascii(F.lit("1"))
    manifest = done.where("o_orderstatus = 'O' or task < '3'").select("rel_path", "task", "episode_index", index.alias("task_index")).where("task < '4'")
    return planner.plan(orders.where("o_orderstatus in ('O', 'P')").select("rel_path", "task"), manifest, "rel_path", "task", "episode_index")


def plan_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).reused.select("rel_path", "task", "episode_index")


def plan_to_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).to_convert.select("rel_path", "task")


def plan_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).removed.select("rel_path", "episode_index")


def plan_task_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).task_index.select("task", "task_index", "is_new")


def plan_next_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).next_episode_index


def compact_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey")
    return planner.compact(survivors, "o_orderkey", 100)


def global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_index")).agg(F.count("*").alias("length"))
    return planner.with_offsets(lengths).select("episode_index", "length", F.col("offset").cast("bigint").alias("offset"))


def frame_global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames table with its index set right."""
    frames = table(spark, sf_dir, "frames").select("index", "episode_index", "frame_index").dropDuplicates(["episode_index", "frame_index"])
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("length"))
    return planner.global_index(frames, planner.with_offsets(lengths)).select("episode_index", "frame_index", F.col("index").cast("bigint").alias("index"))


def renumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the gapless numbers of orders that are not finished."""
    mapping = planner.compact(table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("episode_index")), "episode_index")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_index"), "l_linenumber", "l_partkey")
    return planner.renumber(rows, mapping).select("episode_index", "l_linenumber", "l_partkey")


def missing_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task numbers in use whose task nobody has written as the tasks table spells it."""
    manifest = table(spark, sf_dir, "manifest")
    known = table(spark, sf_dir, "tasks").join(manifest.select("task").distinct(), "task", "left_semi").select("task_index")
    return planner.missing_tasks(manifest.where("task_index is not null"), known)


def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = table(spark, sf_dir, "manifest").groupBy("episode_index", "dataset_source").agg(F.max("length").alias("length"))
    return episodes.groupBy("dataset_source").agg(F.count("*").alias("n_episodes"), F.sum("length").alias("n_frames"))


def frame_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames per task text (lookup of task_index)."""
    per = table(spark, sf_dir, "frames").groupBy("task_index").agg(F.count("*").alias("n"))
    return per.join(table(spark, sf_dir, "tasks"), "task_index").select("task", "n")


QUERIES = {
    f.__name__: f
    for f in (
        task_catalog, task_counts, paths_by_task, match_tasks, select_episodes, numeric_order_cap, shard_names, shard_resolve, plan_reused, plan_to_convert,
        plan_removed, plan_task_index, plan_next_index, compact_indices, global_index, frame_global_index, renumbered, missing_tasks, dataset_totals, frame_tasks,
    )
}

_LISTING = """listing AS (SELECT rel_path AS path, min(episode_index) AS listing_pos FROM manifest WHERE rel_path IS NOT NULL GROUP BY 1),
  catalog AS (SELECT path, listing_pos, CASE WHEN ok THEN p[2] ELSE 'unknown' END AS split, CASE WHEN ok THEN p[3] ELSE 'unknown' END AS path_task
    FROM (SELECT *, string_split(path, '/') AS p, len(string_split(path, '/')) >= 4 AND string_split(path, '/')[1] = 'data' AS ok FROM listing WHERE suffix(path, '.mcap')))"""
_MATCH = f"""{_LISTING}, requests(o, requested) AS (VALUES {", ".join(f"({i}, '{r}')" for i, r in enumerate(REQUESTS))}),
  tasks_listed AS (SELECT path_task, min(listing_pos) AS f FROM catalog GROUP BY 1),
  matched AS (SELECT r.o, r.requested, arg_min(t.path_task, (t.f, t.path_task)) AS path_task, count(t.path_task) AS n_matches
    FROM requests r LEFT JOIN tasks_listed t ON contains(t.path_task, r.requested) GROUP BY 1, 2)"""
_SHARDS = """shards AS (SELECT -s_suppkey AS listing_pos, 'observations/7/' || (s_suppkey * 20) || '-' || (s_suppkey * 20 + 36) || '.tar' AS path,
  s_suppkey * 20 AS lo, s_suppkey * 20 + 36 AS hi FROM supplier)"""
_PLAN = """asked AS (SELECT o_orderkey AS rel_path, o_orderpriority AS task FROM orders WHERE o_orderstatus IN ('O', 'P')),
  done AS (SELECT o_orderkey AS rel_path, o_orderpriority AS task, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS episode_index FROM orders WHERE o_orderstatus IN ('O', 'F')),
  have AS (SELECT rel_path, task, episode_index, ascii(task) - ascii('1') AS task_index FROM done WHERE (o_orderstatus = 'O' OR task < '3') AND task < '4')"""

SQL = {
    "task_catalog": f"WITH {_LISTING} SELECT path, listing_pos, split, path_task FROM catalog",
    "task_counts": f"WITH {_LISTING} SELECT path_task, count(*) AS n FROM catalog GROUP BY 1",
    "paths_by_task": f"WITH {_LISTING} SELECT path_task, row_number() OVER (PARTITION BY path_task ORDER BY listing_pos, path) - 1 AS k, path FROM catalog",
    "match_tasks": f"WITH {_MATCH} SELECT requested, path_task, n_matches FROM matched",
    "select_episodes": f"""WITH {_MATCH}, r AS (SELECT m.requested, c.path_task, c.path, row_number() OVER (PARTITION BY m.requested ORDER BY c.listing_pos) AS place
        FROM matched m JOIN catalog c USING (path_task)) SELECT requested, path_task, path, place FROM r WHERE place <= 5""",
    "numeric_order_cap": """WITH r AS (SELECT o_orderstatus, o_orderkey::VARCHAR AS episode_id, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS place
        FROM (SELECT DISTINCT o_orderstatus, o_orderkey FROM orders)) SELECT * FROM r WHERE place <= 10""",
    "shard_names": f"WITH {_SHARDS} SELECT path, lo, hi FROM shards",
    "shard_resolve": f"""WITH {_SHARDS} SELECT p.p_partkey, arg_min(s.path, s.listing_pos) AS path
        FROM (SELECT DISTINCT p_partkey FROM part) p LEFT JOIN shards s ON p.p_partkey BETWEEN s.lo AND s.hi GROUP BY 1""",
    "plan_reused": f"WITH {_PLAN} SELECT a.rel_path, a.task, h.episode_index FROM asked a JOIN have h USING (rel_path)",
    "plan_to_convert": f"WITH {_PLAN} SELECT rel_path, task FROM asked WHERE rel_path NOT IN (SELECT rel_path FROM have)",
    "plan_removed": f"WITH {_PLAN} SELECT rel_path, episode_index FROM have WHERE rel_path NOT IN (SELECT rel_path FROM asked)",
    "plan_task_index": f"""WITH {_PLAN}, known AS (SELECT task, min(task_index)::BIGINT AS task_index FROM have GROUP BY 1),
        new AS (SELECT DISTINCT task FROM asked WHERE task NOT IN (SELECT task FROM known))
        SELECT task, task_index, false AS is_new FROM known UNION ALL
        SELECT task, (SELECT max(task_index) + 1 FROM known) + row_number() OVER (ORDER BY task) - 1, true FROM new""",
    "plan_next_index": f"WITH {_PLAN} SELECT max(episode_index) + 1 AS next_index FROM have",
    "compact_indices": "SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) - 1 AS new_index FROM orders WHERE o_orderstatus <> 'F'",
    "global_index": """WITH l AS (SELECT l_orderkey AS episode_index, count(*) AS length FROM lineitem GROUP BY 1)
        SELECT episode_index, length, (sum(length) OVER (ORDER BY episode_index) - length)::BIGINT AS offset FROM l""",
    "frame_global_index": """SELECT episode_index, frame_index, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS index
        FROM (SELECT DISTINCT episode_index, frame_index FROM frames)""",
    "renumbered": """WITH m AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders WHERE o_orderstatus <> 'F')
        SELECT m.n AS episode_index, l_linenumber, l_partkey FROM lineitem JOIN m ON l_orderkey = o_orderkey""",
    "missing_tasks": "SELECT DISTINCT task_index FROM manifest WHERE task_index IS NOT NULL AND task_index NOT IN (SELECT task_index FROM tasks WHERE task IN (SELECT task FROM manifest))",
    "dataset_totals": """SELECT dataset_source, count(*) AS n_episodes, sum(length)::BIGINT AS n_frames
        FROM (SELECT episode_index, dataset_source, max(length) AS length FROM manifest GROUP BY 1, 2) GROUP BY 1""",
    "frame_tasks": "SELECT t.task, count(*) AS n FROM frames f JOIN tasks t USING (task_index) GROUP BY t.task_index, t.task",
}
