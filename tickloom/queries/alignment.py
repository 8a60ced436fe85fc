"""Tick grids, as-of alignment, chunks, splits and frame rows over the driver's tables.

events stand in for raw messages: user_id is the episode, event_type the topic,
event_id the read order and ts the log time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import align, catalog, chunk, split, stats
from tickloom.operators.ordered import int_bucket, numbered
from tickloom.queries.tables import table

TOPICS = ["click", "error", "purchase", "signup", "view"]
STEP = 6 * 3600 * 1_000_000_000
DAY_US = 86_400_000_000


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("topic"), t.alias("log_time"), F.col("event_id").alias("seq"), "value")


def _grid(spark, sf_dir) -> DataFrame:
    return align.tick_grid(align.spans_of(messages(spark, sf_dir), ["user_id"], "log_time"), STEP, name="log_time").select("user_id", "log_time")


def tick_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("user_id", F.col("log_time").alias("tick_ns"))


def floor_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = messages(spark, sf_dir).where("topic = 'click'")
    found = align.floor_align(_grid(spark, sf_dir), clicks, ["user_id"], "log_time", ["seq"], "value", STEP)
    return found.select("user_id", F.col("log_time").alias("tick_ns"), "value")


def floor_align_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align.align_topics(messages(spark, sf_dir), "user_id", "topic", "log_time", "seq", "value", TOPICS, STEP)
    return rows.select("user_id", "tick_ns", F.posexplode("vector").alias("pos", "value"))


def missing_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["/left-arm-state", "/left-ee-state", "/right-arm-state", "/right-ee-state", "/left-arm-action", "/left-ee-action", "/right-arm-action", "/right-ee-action"]
    return align.missing_topics(table(spark, sf_dir, "raw_messages").select("episode_id", "topic"), "episode_id", "topic", wanted)


def top_topic_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = align.lock_topic(messages(spark, sf_dir), "user_id", "topic", "seq", ["view", "click"])
    return kept.groupBy("user_id", "topic").agg(F.count("*").alias("n"))


def frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(messages(spark, sf_dir), ["user_id"], ["log_time", "seq"], int_bucket(F.col("log_time"), DAY_US * 1000), "frame_index")
    return rows.select("user_id", "seq", "frame_index", (F.col("frame_index") / 30.0).alias("timestamp"))


def _chunks(spark, sf_dir) -> DataFrame:
    rows = numbered(messages(spark, sf_dir), ["user_id"], ["log_time", "seq"], int_bucket(F.col("log_time"), DAY_US * 1000), "frame_index")
    return chunk.action_chunks(rows, ["user_id"], "frame_index", "value", 4)


def action_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.posexplode(F.arrays_zip(F.col("chunk").alias("value"), F.col("is_pad").alias("is_pad"))).alias("step", "z")
    return _chunks(spark, sf_dir).select("user_id", "frame_index", steps).select("user_id", "frame_index", "step", "z.value", "z.is_pad")


def pad_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.pad_fraction(_chunks(spark, sf_dir))


def frame_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks over the frames table: the first action component, three ticks ahead, of train episodes."""
    frames = table(spark, sf_dir, "frames").select("episode_index", "frame_index", F.get(F.col("action"), F.lit(0)).alias("a")).groupBy("episode_index", "frame_index").agg(F.max("a").alias("a"))
    chunks = chunk.action_chunks(split.only_split(frames, "episode_index", "train", 0.1, 0.1), ["episode_index"], "frame_index", "a", 3)
    return chunks.select("episode_index", "frame_index", F.posexplode("chunk").alias("step", "value"))


def frame_chunks_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of whole action vectors over the frames table, three ticks ahead, of train episodes.

    Of repeated rows the greatest vector holds. Zeros of both signs are equally great; they come out as 0.0, as in the SQL.
    """
    greatest = F.transform(F.max("action"), lambda x: F.when(x == 0, F.lit(0).cast("float")).otherwise(x))
    frames = table(spark, sf_dir, "frames").select("episode_index", "frame_index", "action").groupBy("episode_index", "frame_index").agg(greatest.alias("action"))
    chunks = chunk.action_chunks(split.only_split(frames, "episode_index", "train", 0.1, 0.1), ["episode_index"], "frame_index", "action", 3)
    return chunks.select("episode_index", "frame_index", "chunk", "is_pad")


def episode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    key = F.col("user_id")
    return users.select("user_id", split.hash_fraction(key).alias("fraction"), split.split_label(key, 0.1, 0.1).alias("split"))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_counts(table(spark, sf_dir, "manifest"), "episode_index", 0.1, 0.1)


def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.only_split(table(spark, sf_dir, "events"), "user_id", "val", 0.1, 0.1).select("user_id", "event_id")


def valid_action_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir).withColumn("chunk", F.transform("chunk", lambda x: F.array(x, x * x)))
    out = stats.valid_action_stats(chunks)
    return out.select("pos", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "n")


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with messages of every topic and every camera."""
    seen = table(spark, sf_dir, "raw_messages").select("episode_id", F.col("topic").alias("part")).unionByName(table(spark, sf_dir, "raw_camera").select("episode_id", F.col("camera").alias("part")))
    parts = [f"/{side}-{what}" for side in ("left", "right") for what in ("arm-state", "ee-state", "arm-action", "ee-action")]
    return catalog.complete_episodes(seen, "episode_id", "part", [*parts, "top", "left_wrist", "right_wrist"])


def agreeing_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose frames are as many as the manifest says."""
    frames = table(spark, sf_dir, "frames").select("episode_index", "frame_index").distinct()
    planned = table(spark, sf_dir, "manifest").where("length is not null").select("episode_index", "length").distinct()
    each = planned.select("episode_index", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("length"))).alias("k"))
    return catalog.agreeing_lengths(frames, each, "episode_index")


def fifo_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera rows with data, in read order, paired with the sorted message times of their camera."""
    camera = table(spark, sf_dir, "raw_camera").groupBy("episode_id", "camera", "seq").agg(F.max("log_time").alias("log_time"), F.max(F.col("data").isNotNull()).alias("has_data"))
    keys = ["episode_id", "camera"]
    frames = numbered(camera.where("has_data").select(*keys, "seq"), keys, ["seq"], int_bucket(F.col("seq")), "position")
    times = numbered(camera.where("log_time is not null").select(*keys, "log_time", F.col("seq").alias("s")), keys, ["log_time", "s"], int_bucket(F.col("log_time"), 600_000_000_000), "position")
    return align.fifo_pair(frames, times.select(*keys, "position", "log_time"), keys, "position", "log_time").select(*keys, "seq", "position", "log_time")


def clip_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit(1_704_672_000_000_000_000)  # 2024-01-08
    return catalog.clip(messages(spark, sf_dir), ["user_id"], "log_time", ["log_time", "seq"], start, 5).select("user_id", "seq", F.col("place").cast("bigint").alias("place"))


def even_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.functions.scalars import even_positions

    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.select("user_id", F.posexplode(even_positions(F.col("n"), 7)).alias("k", "position"))


QUERIES = {
    f.__name__: f
    for f in (
        tick_grid, floor_align, floor_align_multi, missing_topics, top_topic_lock, frame_rows, action_chunk, pad_fraction, frame_chunks, frame_chunks_whole, episode_split,
        split_counts, split_filter, valid_action_stats, completeness, agreeing_lengths, fifo_pair, clip_sample, even_frames,
    )
}

_MSG = "msg AS (SELECT user_id, event_type AS topic, epoch_us(ts) * 1000 AS log_time, event_id AS seq, value FROM events)"
_GRID = f"""{_MSG},
  spans AS (SELECT user_id, min(log_time) AS s, max(log_time) AS e FROM msg GROUP BY 1),
  grid AS (SELECT user_id, unnest(generate_series(s, e - 1, {STEP})) AS tick FROM spans WHERE e > s)"""
_FRAC = "CAST(CAST(concat('0x', substr(sha256(concat('0:', {k})), 1, 16)) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"
_LABEL = "CASE WHEN {f} < 0.1 THEN 'val' WHEN {f} < 0.1 + 0.1 THEN 'test' ELSE 'train' END"
_CHUNK = f"""{_MSG},
  numbered AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY log_time, seq) - 1 AS frame_index, count(*) OVER (PARTITION BY user_id) AS n FROM msg),
  steps AS (SELECT a.user_id, a.frame_index, k.step, b.value, a.frame_index + k.step >= a.n AS is_pad
            FROM numbered a CROSS JOIN (SELECT unnest(range(0, 4))::INT AS step) k
            JOIN numbered b ON b.user_id = a.user_id AND b.frame_index = least(a.frame_index + k.step, a.n - 1))"""
_TOPIC_LIST = ", ".join(f"('{t}', {i})" for i, t in enumerate(TOPICS))

SQL = {
    "tick_grid": f"WITH {_GRID} SELECT user_id, tick AS tick_ns FROM grid",
    "floor_align": f"""WITH {_GRID}, clicks AS (SELECT user_id, log_time, max_by(value, seq) AS value FROM msg WHERE topic = 'click' GROUP BY 1, 2),
        firsts AS (SELECT user_id, min_by(value, log_time) AS first_value FROM clicks GROUP BY 1)
        SELECT g.user_id, g.tick AS tick_ns, coalesce(c.value, f.first_value) AS value
        FROM grid g ASOF LEFT JOIN clicks c ON c.user_id = g.user_id AND g.tick >= c.log_time LEFT JOIN firsts f ON f.user_id = g.user_id""",
    "floor_align_multi": f"""WITH {_GRID}, topics(topic, pos) AS (VALUES {_TOPIC_LIST}),
        whole AS (SELECT user_id FROM msg GROUP BY 1 HAVING count(DISTINCT topic) = {len(TOPICS)}),
        keyed AS (SELECT g.user_id, g.tick, t.topic, t.pos FROM grid g JOIN whole USING (user_id) CROSS JOIN topics t),
        one AS (SELECT user_id, topic, log_time, max_by(value, seq) AS value FROM msg GROUP BY 1, 2, 3),
        firsts AS (SELECT user_id, topic, min_by(value, log_time) AS first_value FROM one GROUP BY 1, 2)
        SELECT k.user_id, k.tick AS tick_ns, CAST(k.pos AS INT) AS pos, coalesce(c.value, f.first_value) AS value
        FROM keyed k ASOF LEFT JOIN one c ON c.user_id = k.user_id AND c.topic = k.topic AND k.tick >= c.log_time
        LEFT JOIN firsts f ON f.user_id = k.user_id AND f.topic = k.topic""",
    "missing_topics": """WITH wanted AS (SELECT unnest(['/left-arm-state', '/left-ee-state', '/right-arm-state', '/right-ee-state',
          '/left-arm-action', '/left-ee-action', '/right-arm-action', '/right-ee-action']) AS topic)
        SELECT e.episode_id, w.topic FROM (SELECT DISTINCT episode_id FROM raw_messages) e CROSS JOIN wanted w
        WHERE NOT EXISTS (SELECT 1 FROM raw_messages m WHERE m.episode_id = e.episode_id AND m.topic = w.topic)""",
    "top_topic_lock": """WITH lock AS (SELECT user_id, arg_min(event_type, event_id) AS t FROM events WHERE event_type IN ('view', 'click') GROUP BY 1)
        SELECT e.user_id, e.event_type AS topic, count(*) AS n FROM events e LEFT JOIN lock l USING (user_id)
        WHERE e.event_type NOT IN ('view', 'click') OR e.event_type = l.t GROUP BY 1, 2""",
    "frame_rows": f"""WITH {_MSG}, r AS (SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY log_time, seq) - 1 AS frame_index FROM msg)
        SELECT user_id, seq, frame_index, frame_index / 30.0::DOUBLE AS timestamp FROM r""",
    "action_chunk": f"WITH {_CHUNK} SELECT user_id, frame_index, step, value, is_pad FROM steps",
    "pad_fraction": f"WITH {_CHUNK} SELECT avg(is_pad::INT) AS pad_fraction, count(*) AS n_steps, avg(is_pad::INT) > 0.5 AS mostly_padding FROM steps",
    "frame_chunks": f"""WITH f AS (SELECT episode_index, frame_index, max(action[1]) AS a FROM frames GROUP BY 1, 2),
        t AS (SELECT *, max(frame_index) OVER (PARTITION BY episode_index) AS last FROM f
              WHERE {_LABEL.format(f="(" + _FRAC.format(k="episode_index") + ")")} = 'train')
        SELECT t.episode_index, t.frame_index, k.step, b.a AS value
        FROM t CROSS JOIN (SELECT unnest(range(0, 3))::INT AS step) k
        JOIN f b ON b.episode_index = t.episode_index AND b.frame_index = least(t.frame_index + k.step, t.last)""",
    "frame_chunks_whole": f"""WITH f AS (SELECT episode_index, frame_index, max(action) AS a FROM frames GROUP BY 1, 2),
        t AS (SELECT *, max(frame_index) OVER (PARTITION BY episode_index) AS last FROM f
              WHERE {_LABEL.format(f="(" + _FRAC.format(k="episode_index") + ")")} = 'train')
        SELECT t.episode_index, t.frame_index, list(b.a ORDER BY k.step) AS chunk, list(t.frame_index + k.step > t.last ORDER BY k.step) AS is_pad
        FROM t CROSS JOIN (SELECT unnest(range(0, 3))::INT AS step) k
        JOIN f b ON b.episode_index = t.episode_index AND b.frame_index = least(t.frame_index + k.step, t.last) GROUP BY 1, 2""",
    "episode_split": f"""WITH u AS (SELECT DISTINCT user_id, {_FRAC.format(k="user_id")} AS fraction FROM events)
        SELECT user_id, fraction, {_LABEL.format(f="fraction")} AS split FROM u""",
    "split_counts": f"""WITH u AS (SELECT DISTINCT episode_index, {_FRAC.format(k="episode_index")} AS fraction FROM manifest WHERE episode_index IS NOT NULL)
        SELECT {_LABEL.format(f="fraction")} AS split, count(*) AS n_episodes FROM u GROUP BY 1""",
    "split_filter": f"""WITH u AS (SELECT user_id, event_id, {_FRAC.format(k="user_id")} AS fraction FROM events)
        SELECT user_id, event_id FROM u WHERE fraction < 0.1""",
    "valid_action_stats": f"""WITH {_CHUNK}, e AS (SELECT 0 AS pos, value AS x FROM steps WHERE NOT is_pad UNION ALL SELECT 1, value * value FROM steps WHERE NOT is_pad)
        SELECT pos, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, min(x) AS min, max(x) AS max, count(*) AS n FROM e GROUP BY 1""",
    "completeness": """WITH p AS (SELECT episode_id, topic AS part FROM raw_messages UNION SELECT episode_id, camera FROM raw_camera)
        SELECT episode_id FROM p WHERE part IN ('top', 'left_wrist', 'right_wrist', '/left-arm-state', '/left-ee-state', '/left-arm-action',
          '/left-ee-action', '/right-arm-state', '/right-ee-state', '/right-arm-action', '/right-ee-action')
        GROUP BY 1 HAVING count(DISTINCT part) = 11""",
    "agreeing_lengths": """WITH f AS (SELECT episode_index, count(DISTINCT frame_index) AS n FROM frames GROUP BY 1),
        m AS (SELECT episode_index, sum(length)::BIGINT AS n FROM (SELECT DISTINCT episode_index, length FROM manifest WHERE length IS NOT NULL) GROUP BY 1)
        SELECT f.episode_index, f.n AS length FROM f JOIN m ON m.episode_index = f.episode_index AND m.n = f.n""",
    "fifo_pair": """WITH c AS (SELECT episode_id, camera, seq, max(log_time) AS log_time, bool_or(data IS NOT NULL) AS has_data FROM raw_camera GROUP BY 1, 2, 3),
        f AS (SELECT episode_id, camera, seq, row_number() OVER (PARTITION BY episode_id, camera ORDER BY seq) - 1 AS position FROM c WHERE has_data),
        t AS (SELECT episode_id, camera, log_time, row_number() OVER (PARTITION BY episode_id, camera ORDER BY log_time, seq) - 1 AS position FROM c WHERE log_time IS NOT NULL),
        l AS (SELECT episode_id, camera, max(log_time) AS last FROM c GROUP BY 1, 2)
        SELECT f.episode_id, f.camera, f.seq, f.position, coalesce(t.log_time, l.last) AS log_time
        FROM f LEFT JOIN t USING (episode_id, camera, position) LEFT JOIN l USING (episode_id, camera)""",
    "clip_sample": f"""WITH {_MSG}, r AS (SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY log_time, seq) AS place FROM msg WHERE log_time >= 1704672000000000000)
        SELECT user_id, seq, place FROM r WHERE place <= 5""",
    "even_frames": """WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
        SELECT c.user_id, k.k, CAST(trunc(k.k::DOUBLE * (c.n - 1) / 6) AS BIGINT) AS position FROM c CROSS JOIN (SELECT unnest(range(0, 7))::INT AS k) k""",
}
