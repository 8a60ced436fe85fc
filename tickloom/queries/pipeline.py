"""The conversion pipeline over raw messages and cameras, datasets on disk, and user functions.

Messages and camera rows outside their recording, or without content, are no readings (see operators.grid.readings).
"""

from __future__ import annotations

import itertools
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import udf
from tickloom.operators import align, catalog, metrics, split
from tickloom.operators.grid import readings, recording_spans
from tickloom.plans import prepare, train
from tickloom.queries.tables import table
from tickloom.runtime import lookup_join, materialize, tables_dir
from tickloom.schema import RobotSchema, schemas_of
from tickloom.sources import root as dataset


def _schemas(spark: SparkSession, sf_dir: str) -> list[RobotSchema]:
    """Schemas of the sources whose recordings are message files."""
    found = schemas_of(table(spark, sf_dir, "robot_schemas"))
    return [s for _, s in sorted(found.items()) if s.ingestion_strategy == "mcap"]


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of messages and cameras as recordings give them, each once: dataset_source, episode_id, topic, log_time, seq, value, data, format."""
    recordings = table(spark, sf_dir, "recordings")
    spans = recording_spans(recordings, table(spark, sf_dir, "robot_schemas"))
    sources = recordings.where("episode_id is not null").groupBy("episode_id").agg(F.min("dataset_source").alias("dataset_source"))
    keys = ["episode_id", "topic", "log_time", "seq"]
    vectors = readings(table(spark, sf_dir, "raw_messages"), spans, size_of=recordings).select(*keys, "value", F.lit(None).cast("binary").alias("data"), F.lit(None).cast("string").alias("format"))
    shots = readings(table(spark, sf_dir, "raw_camera"), spans, "data", size_of=recordings)
    shots = shots.select("episode_id", F.concat(F.lit("/"), "camera").alias("topic"), "log_time", "seq", F.lit(None).cast("array<double>").alias("value"), "data", "format")
    return lookup_join(vectors.unionByName(shots).dropDuplicates(keys), sources, "episode_id", size_of=recordings)


def _each(spark: SparkSession, sf_dir: str, what) -> DataFrame:
    """what(messages, schema) for each source, put together. The readings are read once."""
    rows = materialize(recorded(spark, sf_dir), "recorded")
    return reduce(DataFrame.unionByName, [what(rows.where(F.col("dataset_source") == s.dataset_source).drop("dataset_source"), s) for s in _schemas(spark, sf_dir)])


def aligned_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and action of every tick of every whole episode, on the grid that messages and cameras span."""

    def flat(messages: DataFrame, schema: RobotSchema) -> DataFrame:
        frames = prepare.aligned_frames(messages, schema)
        return frames.select("episode_id", "frame_index", F.posexplode(F.concat("`observation.state`", "action")).alias("pos", "value"))

    return _each(spark, sf_dir, flat)


def camera_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of the frame that each camera shows at each tick."""

    def flat(messages: DataFrame, schema: RobotSchema) -> DataFrame:
        frames = prepare.aligned_frames(messages, schema)
        shown = F.explode(F.create_map(*(x for c in schema.camera_keys for x in (F.lit(c), F.col(f"`camera_frame.{c}`"))))).alias("camera", "frame")
        return frames.select("episode_id", "frame_index", shown)

    return _each(spark, sf_dir, flat)


def episode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings that lack a topic or a camera, and of which."""
    return _each(spark, sf_dir, prepare.rejects)


def direct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows straight from messages: episodes, rows and padded steps by source, in chunks of 20 actions."""

    def rows(messages: DataFrame, schema: RobotSchema) -> DataFrame:
        tasks = messages.select("episode_id", F.lit("any").alias("task")).distinct()
        made = train.direct_rows(messages, tasks, schema, 20)
        padded = F.sum(F.size(F.filter("action_is_pad", lambda p: p))).cast("bigint")
        return made.groupBy("episode_id").agg(F.count("*").alias("n_rows"), padded.alias("n_padded"))

    return _each(spark, sf_dir, rows)


_written: dict[tuple[str, str], str] = {}


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "frames").where("episode_index is not null and frame_index is not null").dropDuplicates(["episode_index", "frame_index"])
    return frames.select("episode_index", "frame_index", F.coalesce("task_index", F.lit(0)).alias("task_index"), "`observation.state`", "action")


def _root(spark: SparkSession, sf_dir: str) -> str:
    """All frames written as a dataset, once an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        tasks = table(spark, sf_dir, "tasks").where("task_index is not null").groupBy("task_index").agg(F.min("task").alias("task"))
        schema = RobotSchema("all", "mcap", 20.0, ("top",), (("s", 1),), (("a", 1),))
        place = f"{tables_dir(spark)}/root-{len(_written)}"
        dataset.write_root(_frames(spark, sf_dir), tasks, schema, place if "://" in place else place.removeprefix("file:"), {"image_size": [224, 224]})
        _written[key] = place if "://" in place else place.removeprefix("file:")
    return _written[key]


def root_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written as a dataset and read again: global index, timestamp and task."""
    rows = dataset.read_frames(spark, _root(spark, sf_dir))
    return rows.select("episode_index", "frame_index", "index", F.round("timestamp", 6).alias("timestamp"), "task", F.size("action").alias("n_action"))


def root_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The episodes table of the dataset: length, and the chunk and file that hold each."""
    rows = spark.read.parquet(f"{_root(spark, sf_dir)}/meta/episodes/chunk-000")
    return rows.select("episode_index", "length", F.col("`data/chunk_index`").alias("chunk"), F.col("`data/file_index`").alias("file"), F.col("`videos/top/file_index`").alias("video"))


def root_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What info.json says of the dataset."""
    info = dataset.read_info(_root(spark, sf_dir))
    shape = info["features"]["top"]["shape"]
    return spark.createDataFrame([(info["total_frames"], info["total_episodes"], info["fps"], *shape)], "total_frames bigint, total_episodes bigint, fps double, height int, width int, channels int")


def root_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows read from the dataset: padded steps of chunks of 8 actions, by episode."""
    rows = dataset.read_training_rows(spark, _root(spark, sf_dir), 8)
    return rows.groupBy("episode_index").agg(F.count("*").alias("n_rows"), F.sum(F.size(F.filter("action_is_pad", lambda p: p))).cast("bigint").alias("n_padded"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value")


def udf_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    def scaled(row: dict, by: float) -> dict:
        return {"event_id": row["event_id"], "scaled": row["value"] * by}

    return udf.map_rows(_events(spark, sf_dir), scaled, "event_id bigint, scaled double", (2.0,))


class _Shifted:
    """Built once a task."""

    def __init__(self, by: float):
        self.by = by

    def __call__(self, batch: pa.RecordBatch) -> pa.Table:
        return pa.table({"event_id": batch["event_id"], "shifted": pc.add(batch["value"], self.by)})


def udf_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return udf.map_batches(_events(spark, sf_dir), _Shifted, "event_id bigint, shifted double", 500, fn_constructor_kwargs={"by": 0.5})


def udf_flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of event types, place by place."""

    def letters(row: dict):
        for i, x in enumerate(row["event_type"]):
            yield {"event_id": row["event_id"], "place": i, "letter": x}

    return udf.flat_map(_events(spark, sf_dir), letters, "event_id bigint, place int, letter string")


def udf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return udf.filter_rows(_events(spark, sf_dir), lambda row: row["event_type"] != "view" and row["value"] > 1)


def udf_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function that fails for some rows: they become rows with an error, and are counted."""

    def inverse(row: dict):
        if row["event_type"] == "error":
            raise KeyError("no value")
        yield {"kind": row["event_type"]}

    rows = udf.flat_map(_events(spark, sf_dir), udf.tolerant(inverse), "kind string, error string")
    return rows.groupBy("kind", F.col("error").isNotNull().alias("failed")).agg(F.count("*").alias("n"))


def leader_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every worker with what worker 0 decided at that step."""
    rows = _events(spark, sf_dir).select("event_id", F.expr("event_id div 4").alias("step"), F.expr("cast(event_id % 4 as int)").alias("rank"), (F.col("value") < 1).alias("stop"))
    return metrics.led(rows.select("step", "rank", "stop"), rows.select("event_id", "step", "rank"), ["step"], "rank").select("event_id", "stop")


def checked_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes per split, after the check that none which is wanted is empty."""
    counts = split.split_counts(table(spark, sf_dir, "manifest"), "episode_index", 0.2, 0.1, 3)
    split.check_split(counts, 0.2, 0.1)
    return counts


def first_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language the size that the first document with a known one has, as the shape of a record."""
    shapes = F.create_map("lang", F.when(F.col("n_chars") > 200, F.array("n_chars")))
    return catalog.first_shapes(table(spark, sf_dir, "documents").where("lang is not null").select("doc_id", shapes.alias("depth_shapes")), "doc_id").select(F.col("camera").alias("lang"), F.get("shape", F.lit(0)).alias("n_chars"))


def first_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the topics that may carry the left arm the one that a recording has first."""
    return align.first_seen(table(spark, sf_dir, "raw_messages").where("log_time is not null"), "episode_id", "topic", "log_time", ["/left-arm-state", "/left-arm-action"])


def vector_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read as Arrow batches on the driver, one partition at a time: batches and rows."""
    sizes = [b.num_rows for b in udf.iter_batches(table(spark, sf_dir, "tasks"), 100)]
    return spark.createDataFrame([(sum(sizes), max(itertools.chain(sizes, [0])) <= 100)], "n_rows bigint, bounded boolean")


QUERIES = {
    f.__name__: f
    for f in (
        aligned_frames, camera_align, episode_rejects, direct_rows, root_frames, root_episodes, root_info, root_training_rows, udf_map, udf_batches, udf_flat_map, udf_filter,
        udf_tolerant, leader_decision, checked_split, first_shapes, first_topic, vector_batches,
    )
}

_VECTORS = ["left-arm", "left-ee", "right-arm", "right-ee"]
_TOPICS = [*(f"/{v}-state" for v in _VECTORS), *(f"/{v}-action" for v in _VECTORS)]
_CAMERAS = ["left_wrist", "right_wrist", "top"]
_LISTED = ", ".join(f"('{t}', {i})" for i, t in enumerate([*_TOPICS, *(f"camera {c}" for c in _CAMERAS)]))
_SIGNALS = f"""spans AS (
    SELECT DISTINCT r.episode_id, r.start_ns, r.end_ns, CAST(trunc(1e9 / s.tick_fps) AS BIGINT) AS step
    FROM recordings r JOIN robot_schemas s USING (dataset_source) WHERE r.end_ns > r.start_ns AND s.ingestion_strategy = 'mcap'),
  shots AS (
    SELECT DISTINCT c.episode_id, c.camera, c.log_time, c.seq FROM raw_camera c JOIN spans p USING (episode_id)
    WHERE c.data IS NOT NULL AND c.log_time >= p.start_ns AND c.log_time < p.end_ns),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY episode_id, camera ORDER BY log_time, seq) - 1 AS frame FROM shots),
  wanted(topic, pos) AS (VALUES {_LISTED}),
  sig AS (
    SELECT m.episode_id, m.topic, m.log_time, max_by(m.value, m.seq) AS value FROM raw_messages m JOIN spans p USING (episode_id)
    WHERE m.value IS NOT NULL AND len(m.value) > 0 AND m.log_time >= p.start_ns AND m.log_time < p.end_ns GROUP BY 1, 2, 3
    UNION ALL SELECT episode_id, 'camera ' || camera, log_time, [max(frame)::DOUBLE] FROM numbered GROUP BY 1, 2, 3),
  held AS (SELECT s.*, w.pos FROM sig s JOIN wanted w USING (topic))"""
_ALIGNED = f"""{_SIGNALS},
  whole AS (SELECT episode_id, min(log_time) AS s, max(log_time) AS e FROM held GROUP BY 1 HAVING count(DISTINCT topic) = 11),
  grid AS (SELECT w.episode_id, w.s, p.step, unnest(generate_series(w.s, w.e - 1, p.step)) AS tick FROM whole w JOIN spans p USING (episode_id) WHERE w.e > w.s),
  firsts AS (SELECT episode_id, topic, min_by(value, log_time) AS first_value FROM held GROUP BY 1, 2),
  keyed AS (SELECT g.*, w.topic, w.pos FROM grid g CROSS JOIN wanted w),
  found AS (
    SELECT k.episode_id, (k.tick - k.s) // k.step AS frame_index, k.topic, k.pos, coalesce(h.value, f.first_value) AS value
    FROM keyed k ASOF LEFT JOIN held h ON h.episode_id = k.episode_id AND h.topic = k.topic AND k.tick >= h.log_time
    LEFT JOIN firsts f ON f.episode_id = k.episode_id AND f.topic = k.topic)"""
_PADDED = "CAST(sum(greatest(0, {k} - (n - i))) AS BIGINT) AS n_padded"
_ONCE = "once AS (SELECT episode_index, frame_index, max(coalesce(task_index, 0)) AS task_index, max(coalesce(len(action), -1)) AS n_action FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL GROUP BY 1, 2)"

SQL = {
    "aligned_frames": f"""WITH {_ALIGNED},
        flat AS (SELECT episode_id, frame_index, pos AS topic, unnest(range(0, len(value))) AS k, unnest(value) AS value FROM found WHERE pos < 8)
        SELECT episode_id, frame_index, CAST(row_number() OVER (PARTITION BY episode_id, frame_index ORDER BY topic, k) - 1 AS INT) AS pos, value FROM flat""",
    "camera_align": f"""WITH {_ALIGNED} SELECT episode_id, frame_index, substr(topic, 8) AS camera, CAST(value[1] AS BIGINT) AS frame FROM found WHERE pos >= 8""",
    "episode_rejects": f"""WITH {_SIGNALS},
        seen AS (SELECT episode_id, topic FROM sig),
        every AS (SELECT DISTINCT episode_id FROM seen)
        SELECT e.episode_id, 'no message of ' || w.topic AS reason FROM every e CROSS JOIN wanted w WHERE (e.episode_id, w.topic) NOT IN (SELECT (episode_id, topic) FROM seen)
        UNION ALL SELECT episode_id, 'too short' FROM held GROUP BY 1 HAVING min(log_time) = max(log_time)""",
    "direct_rows": f"""WITH {_ALIGNED}, rows_of AS (SELECT DISTINCT episode_id, frame_index AS i FROM found), counted AS (SELECT *, count(*) OVER (PARTITION BY episode_id) AS n FROM rows_of)
        SELECT episode_id, count(*) AS n_rows, {_PADDED.format(k=20)} FROM counted GROUP BY 1""",
    "root_frames": f"""WITH {_ONCE}, names AS (SELECT task_index, min(task) AS task FROM tasks GROUP BY 1),
        lengths AS (SELECT episode_index, count(*) AS length FROM once GROUP BY 1),
        offsets AS (SELECT episode_index, coalesce(sum(length) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM lengths)
        SELECT f.episode_index, f.frame_index, CAST(o.o + f.frame_index AS BIGINT) AS "index", round(f.frame_index / 20.0, 6) AS timestamp, n.task, nullif(f.n_action, -1)::INT AS n_action
        FROM once f JOIN offsets o USING (episode_index) LEFT JOIN names n USING (task_index)""",
    "root_episodes": f"""WITH {_ONCE} SELECT episode_index, count(*) AS length, CAST(episode_index // 1000 AS BIGINT) AS chunk, episode_index AS file, episode_index AS video FROM once GROUP BY 1""",
    "root_info": f"""WITH {_ONCE} SELECT count(*) AS total_frames, count(DISTINCT episode_index) AS total_episodes, 20.0::DOUBLE AS fps, 224 AS height, 224 AS width, 3 AS channels FROM once""",
    "root_training_rows": f"""WITH {_ONCE}, counted AS (SELECT episode_index, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS i, count(*) OVER (PARTITION BY episode_index) AS n FROM once)
        SELECT episode_index, count(*) AS n_rows, {_PADDED.format(k=8)} FROM counted GROUP BY 1""",
    "udf_map": "SELECT event_id, value * 2.0 AS scaled FROM events",
    "udf_batches": "SELECT event_id, value + 0.5 AS shifted FROM events",
    "udf_flat_map": "SELECT event_id, (k - 1)::INT AS place, event_type[k] AS letter FROM events CROSS JOIN (SELECT unnest(range(1, 20)) AS k) WHERE k <= length(event_type)",
    "udf_filter": "SELECT event_id, event_type, value FROM events WHERE event_type <> 'view' AND value > 1",
    "udf_tolerant": "SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, event_type = 'error' AS failed, count(*) AS n FROM events GROUP BY 1, 2",
    "leader_decision": "SELECT e.event_id, l.value < 1 AS stop FROM events e LEFT JOIN events l ON l.event_id = e.event_id // 4 * 4",
    "checked_split": """WITH e AS (SELECT DISTINCT episode_index FROM manifest WHERE episode_index IS NOT NULL),
        f AS (SELECT CAST(CAST(concat('0x', substr(sha256(concat('3:', episode_index)), 1, 16)) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0 AS f FROM e)
        SELECT CASE WHEN f < 0.2 THEN 'val' WHEN f < 0.2 + 0.1 THEN 'test' ELSE 'train' END AS split, count(*) AS n_episodes FROM f GROUP BY 1""",
    "first_shapes": "SELECT lang, min_by(n_chars, doc_id) AS n_chars FROM documents WHERE lang IS NOT NULL AND n_chars > 200 GROUP BY 1",
    "first_topic": """WITH m AS (SELECT episode_id, topic, log_time FROM raw_messages WHERE log_time IS NOT NULL AND topic IN ('/left-arm-state', '/left-arm-action'))
        SELECT episode_id, min_by(topic, log_time) AS topic FROM m GROUP BY 1""",
    "vector_batches": "SELECT count(*) AS n_rows, TRUE AS bounded FROM tasks",
}
