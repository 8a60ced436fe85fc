"""Action spaces, relative actions, images and vector statistics over embeddings (64 numbers each) and frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import actions, images, stats
from tickloom.queries.tables import table

#: Components that the 64 numbers of an embedding stand for.
PARTS = (("a", 20), ("b", 30), ("c", 14))
STATE_PARTS = (("c", 14), ("a", 20), ("d", 30))


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def action_space_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = actions.positions(PARTS, [("a", 20), ("c", 14)])
    one = actions.select_actions(_vectors(spark, sf_dir), "v", at, actions.width(PARTS), chunked=False)
    return one.select("vec_id", F.posexplode("v").alias("pos", "value"))


def delta_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk of the vector and its reverse, relative to the vector as a state with components in another order."""
    at = actions.state_positions(PARTS, STATE_PARTS)
    chunk = F.array(F.col("v"), F.reverse("v"))
    rows = _vectors(spark, sf_dir).select("vec_id", actions.relative_chunk(chunk, F.col("v"), at).alias("chunk"))
    return rows.select("vec_id", F.posexplode("chunk").alias("step", "a")).select("vec_id", "step", F.posexplode("a").alias("pos", "value"))


def normalize_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    s = parts.agg(F.avg("p_retailprice").alias("m"), F.stddev_pop("p_retailprice").alias("s"))
    x = F.col("p_retailprice")
    return parts.crossJoin(F.broadcast(s)).select(
        "p_partkey", F.round(images.normalized(x, "mean_std", F.col("m"), F.col("s")), 6).alias("mean_std"), F.round(images.normalized(x, "unit01"), 9).alias("unit01"),
        F.round(images.normalized(x, "unit_pm1"), 9).alias("unit_pm1"), F.round(images.normalized(x, "depth", limit=1000.0), 9).alias("depth"), F.round(images.normalized(x, "log", limit=1000.0), 9).alias("log"),
    )


def reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).select("vec_id", F.posexplode(images.reshape(F.col("v"), 4, 4, 4)).alias("y", "row"))
    cells = rows.select("vec_id", "y", F.posexplode("row").alias("x", "pixel"))
    return cells.select("vec_id", "y", "x", F.posexplode("pixel").alias("channel", "value"))


def hwc_to_chw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", F.posexplode(images.hwc_to_chw(F.col("v"), 4, 4, 4)).alias("pos", "value"))


def replicate_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", F.posexplode(images.replicate_channels(F.col("v"), 1)).alias("pos", "value"))


def _rounded(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("int").alias(key), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "n")


def state_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.vector_stats(_vectors(spark, sf_dir), "v"), "pos")


def state_stats_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the first 300 rows by number, the sample that normalisation may be fitted on."""
    return _rounded(stats.vector_stats(stats.head(_vectors(spark, sf_dir), "vec_id", 300), "v"), "pos")


def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.channel_stats(_vectors(spark, sf_dir), "v", 4), "channel")


def vector_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of the state components of all frames; NaN counts as the greatest number."""
    ranges = stats.vector_stats(table(spark, sf_dir, "frames"), "observation.state")
    return ranges.select("pos", F.col("min").alias("least"), F.isnan("max").alias("has_nan"), "n")


QUERIES = {
    f.__name__: f
    for f in (action_space_select, delta_actions, normalize_modes, reshape, hwc_to_chw, replicate_channels, state_stats, state_stats_head, channel_stats, vector_ranges)
}

_FLAT = "v AS (SELECT vec_id, unnest(range(0, len(embedding)))::INT AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)"
_STATS = "round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, min(x) AS min, max(x) AS max, count(*) AS n"

SQL = {
    "action_space_select": f"""WITH {_FLAT} SELECT vec_id, CASE WHEN pos < 20 THEN pos ELSE pos - 30 END AS pos, x AS value FROM v WHERE pos < 20 OR pos >= 50""",
    "delta_actions": f"""WITH {_FLAT}, steps AS (SELECT vec_id, 0 AS step, pos, x FROM v UNION ALL SELECT vec_id, 1, 63 - pos, x FROM v)
        SELECT s.vec_id, s.step, s.pos, CASE WHEN s.pos < 20 OR s.pos >= 50 THEN s.x - w.x ELSE s.x END AS value
        FROM steps s JOIN v w ON w.vec_id = s.vec_id AND w.pos = CASE WHEN s.pos < 20 THEN s.pos + 14 WHEN s.pos >= 50 THEN s.pos - 50 ELSE 0 END""",
    "normalize_modes": """WITH s AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS s FROM part)
        SELECT p_partkey, round((p_retailprice - m) / s, 6) AS mean_std, round(p_retailprice / 255.0, 9) AS unit01, round(p_retailprice / 127.5 - 1.0, 9) AS unit_pm1,
          round(least(greatest(p_retailprice, 0), 1000.0) / 1000.0, 9) AS depth, round(ln(1 + greatest(p_retailprice, 0)) / ln(1001.0), 9) AS log FROM part, s""",
    "reshape": f"WITH {_FLAT} SELECT vec_id, pos // 16 AS y, pos // 4 % 4 AS x, pos % 4 AS channel, v.x AS value FROM v",
    "hwc_to_chw": f"WITH {_FLAT} SELECT vec_id, (pos % 4) * 16 + pos // 4 AS pos, x AS value FROM v",
    "replicate_channels": f"WITH {_FLAT} SELECT vec_id, (pos + 64 * k.k)::INT AS pos, x AS value FROM v CROSS JOIN (SELECT unnest(range(0, 3)) AS k) k",
    "state_stats": f"WITH {_FLAT} SELECT pos, {_STATS} FROM v GROUP BY 1",
    "state_stats_head": f"WITH {_FLAT} SELECT pos, {_STATS} FROM v WHERE vec_id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 300) GROUP BY 1",
    "channel_stats": f"WITH {_FLAT} SELECT pos % 4 AS channel, {_STATS} FROM v GROUP BY 1",
    "vector_ranges": """WITH f AS (SELECT unnest(range(0, len("observation.state")))::INT AS pos, unnest("observation.state") AS x FROM frames)
        SELECT pos, min(x)::DOUBLE AS least, count(*) FILTER (WHERE isnan(x)) > 0 AS has_nan, count(x) AS n FROM f GROUP BY 1""",
}
