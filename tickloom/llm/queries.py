"""Queries of the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.leaks import find_leaks
from tickloom.llm.nearest import camera_states
from tickloom.llm.quantiles import SHARES, day_sketches, frame_percentiles, percentiles_of_days
from tickloom.llm.spans import shared_spans
from tickloom.llm.splits import episode_groups, split_episodes
from tickloom.llm.tokens import token_ids
from tickloom.operators.frames import episode_sources
from tickloom.queries.tables import table
from tickloom.runtime import lookup_join, materialize


def p1_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_percentiles(table(spark, sf_dir, "frames"), table(spark, sf_dir, "manifest"))


def p1_percentiles_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one sketch per recording day, kept as a table and put together later."""
    days = day_sketches(table(spark, sf_dir, "frames"), table(spark, sf_dir, "manifest"))
    return percentiles_of_days(materialize(days, "day-sketches"))


def p1_rank_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every percentile against all readings: whether its rank is within rank_error of the wanted one."""
    frames, manifest = table(spark, sf_dir, "frames"), table(spark, sf_dir, "manifest")
    found = materialize(frame_percentiles(frames, manifest), "percentiles")
    keys = ["dataset_source", "feature", "component"]
    # a row a source and component, whatever the number of frames; plain numbers, so that sums stay in the hash aggregate
    value = [f"v{i}" for i in range(len(SHARES))]
    wanted = F.broadcast(found.groupBy(*keys).agg(*(F.max(F.when(F.col("q") == q, F.col("value"))).alias(v) for q, v in zip(SHARES, value, strict=True))))
    rows = lookup_join(frames.dropDuplicates(["episode_index", "frame_index"]), episode_sources(manifest), "episode_index", size_of=manifest)
    vectors = F.explode(F.create_map(F.lit("observation.state"), F.col("`observation.state`"), F.lit("action"), F.col("action"))).alias("feature", "v")
    readings = rows.select("dataset_source", vectors).select("dataset_source", "feature", F.posexplode("v").alias("component", "x")).where("x is not null and not isnan(x) and abs(x) < float('inf')")
    count = lambda is_so, name: [F.sum(is_so(F.col(v)).cast("bigint")).alias(f"{name}{i}") for i, v in enumerate(value)]
    sums = readings.join(wanted, keys).groupBy(*keys).agg(F.count("*").alias("exact_n"), *count(lambda v: F.col("x") < v, "below"), *count(lambda v: F.col("x") <= v, "upto"))
    each = F.inline(F.array(*(F.struct(F.lit(q).alias("q"), F.col(f"below{i}").alias("below"), F.col(f"upto{i}").alias("upto")) for i, q in enumerate(SHARES))))
    both = sums.select(*keys, "exact_n", each).join(found, [*keys, "q"])
    rank = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n")))
    within = (F.col("n") == F.col("exact_n")) & (rank > F.col("below") - F.col("rank_error")) & (rank <= F.col("upto") + F.col("rank_error")) & (F.col("upto") > F.col("below"))
    return both.select("dataset_source", "feature", F.col("component").cast("bigint").alias("component"), "q", "n", within.alias("within"), (F.col("rank_error") < 0.01 * F.col("n")).alias("small"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episode_groups(table(spark, sf_dir, "manifest"), table(spark, sf_dir, "tasks")).select("episode_index", "group_index")


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_episodes(table(spark, sf_dir, "manifest"), table(spark, sf_dir, "tasks"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera_states(*(table(spark, sf_dir, t) for t in ("raw_camera", "raw_messages", "recordings", "robot_schemas")))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).where("distance = 0").select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with at most one changed word in thirteen; an item of fewer words leaks if it stands in a text as a whole."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), short=True).select("doc_id", "item_id", "distance")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents")).select("doc_id", F.col("shared_chars").cast("bigint").alias("shared_chars"))


QUERIES = {
    "p1_percentiles": p1_percentiles,
    "p1_percentiles_of_days": p1_percentiles_of_days,
    "p1_rank_check": p1_rank_check,
    "p3_found": p3_found,
    "p3_splits": p3_splits,
    "p5_found": p5_found,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p9_found": p9_found,
}

SQL = {
    "p1_rank_check": """
        WITH sources AS (SELECT episode_index, min(dataset_source) AS dataset_source FROM manifest WHERE episode_index IS NOT NULL AND dataset_source IS NOT NULL GROUP BY 1),
        once AS (SELECT episode_index, frame_index, any_value("observation.state") AS s, any_value(action) AS a FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL GROUP BY 1, 2),
        vectors AS (SELECT dataset_source, 'observation.state' AS feature, s AS v FROM once JOIN sources USING (episode_index)
                    UNION ALL SELECT dataset_source, 'action', a FROM once JOIN sources USING (episode_index)),
        readings AS (SELECT dataset_source, feature, unnest(range(0, len(v))) AS component, unnest(v) AS x FROM vectors),
        counts AS (SELECT dataset_source, feature, component, count(*) AS n FROM readings WHERE x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x) GROUP BY 1, 2, 3)
        SELECT dataset_source, feature, component, q, n, TRUE AS within, TRUE AS small FROM counts CROSS JOIN (SELECT unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])::DOUBLE AS q)""",
    "p9_found": """
        WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 100),
        parts AS (SELECT doc_id, n, unnest(range(0, n, 1000)) AS o, text FROM d),
        cut AS (SELECT doc_id, n, o, substr(text, o + 1, 1099) AS part FROM parts),
        windows AS (SELECT doc_id, o + k AS i, substr(part, k + 1, 100) AS s FROM (SELECT *, unnest(range(0, least(1000, n - 99 - o))) AS k FROM cut WHERE n - 99 - o > 0)),
        shared AS (SELECT s FROM windows GROUP BY 1 HAVING min(doc_id) <> max(doc_id)),
        found AS (SELECT DISTINCT w.doc_id, w.i FROM windows w SEMI JOIN shared USING (s)),
        gaps AS (SELECT doc_id, least(100, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 100)) AS fresh FROM found)
        SELECT doc_id, CAST(sum(fresh) AS BIGINT) AS shared_chars FROM gaps GROUP BY 1""",
    "p5_found": """
        WITH spans AS (SELECT DISTINCT episode_id, start_ns, end_ns FROM recordings WHERE end_ns > start_ns),
        shots AS (
          SELECT DISTINCT c.episode_id, c.camera, c.seq AS camera_seq, c.log_time,
                 CASE WHEN c.camera = 'right_wrist' THEN '/right-arm-state' ELSE '/left-arm-state' END AS topic
          FROM raw_camera c JOIN spans s USING (episode_id)
          WHERE c.data IS NOT NULL AND c.log_time >= s.start_ns AND c.log_time < s.end_ns),
        states AS (
          SELECT DISTINCT m.episode_id, m.topic, m.seq, m.log_time FROM raw_messages m JOIN spans s USING (episode_id)
          WHERE m.value IS NOT NULL AND len(m.value) > 0 AND m.log_time >= s.start_ns AND m.log_time < s.end_ns),
        pairs AS (
          SELECT c.episode_id, c.camera, c.camera_seq, s.seq AS state_seq,
                 row_number() OVER (PARTITION BY c.episode_id, c.camera, c.camera_seq, c.log_time
                                    ORDER BY abs(s.log_time - c.log_time), s.log_time, s.seq) AS place
          FROM shots c JOIN states s ON s.episode_id = c.episode_id AND s.topic = c.topic
           AND s.log_time BETWEEN c.log_time - 20000000 AND c.log_time + 20000000)
        SELECT episode_id, camera, camera_seq, state_seq FROM pairs WHERE place = 1""",
}
