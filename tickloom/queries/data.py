"""Queries of the general training-data operators (problems 2, 4 and 6)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.compaction import compact, consolidate, records, unique_records
from tickloom.operators.grid import regular_grid
from tickloom.operators.spikes import implausible_readings
from tickloom.queries.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings off the rolling median of 15 frames by more than k MADs of their source, out of its bounds, or stuck."""
    return implausible_readings(table(spark, sf_dir, "frames"), table(spark, sf_dir, "manifest"))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regular_grid(table(spark, sf_dir, "raw_messages"), table(spark, sf_dir, "recordings"), table(spark, sf_dir, "robot_schemas"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).where("missing").select("episode_id", "topic", "tick")


def p4_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid, one row per component."""
    flat = _grid(spark, sf_dir).select(
        "episode_id", "topic", "tick", "n_readings", F.posexplode("value").alias("component", "value"), "increment", F.round("covered", 4).alias("covered")
    )
    return flat.select(
        "episode_id", "topic", "tick", "component", "n_readings", F.round("value", 4).alias("value"), F.round(F.get("increment", "component"), 4).alias("increment"), "covered"
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_records(table(spark, sf_dir, "record_files"), size="size_bytes").select("episode_index", "length")


def p6_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated files: outputs, lines and records that they hold, and whether each line is a record."""
    parts = compact(table(spark, sf_dir, "record_files"), size="size_bytes")
    held = records(parts).groupBy("episode_index", "length").agg(F.count("*").alias("times"))
    lines = parts.agg(F.count_distinct("out_file").alias("n_outputs"), F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_lines"))
    return held.agg(F.count("*").alias("n_records"), F.coalesce(F.max("times"), F.lit(0)).alias("most_often")).crossJoin(lines)


def p6_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiny files of zstandard frames joined as they are: files taken, and bytes that come out of the joined frames."""
    files = table(spark, sf_dir, "record_files").select("file_id", F.col("body").cast("binary").alias("body")).where(F.octet_length("body") > 0)
    joined = consolidate(files.mapInArrow(_packed, "file_id bigint, body binary"), frames=True)
    return joined.mapInArrow(_unpacked, "n_files bigint, n_bytes bigint").agg(F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor().compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["file_id"], pa.array([pack(x) for x in batch["body"].to_pylist()], pa.binary())], names=["file_id", "body"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for content in batch["content"].to_pylist():
            reader = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True)
            sizes.append(sum(len(x) for x in iter(lambda reader=reader: reader.read(1 << 20), b"")))
        yield pa.RecordBatch.from_arrays([batch["n_files"], pa.array(sizes, pa.int64())], names=["n_files", "n_bytes"])


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_grid": p4_grid, "p6_found": p6_found, "p6_compact": p6_compact, "p6_zstd": p6_zstd}

SQL = {
    "p4_found": """
        WITH spans AS (
          SELECT DISTINCT r.episode_id, r.start_ns, r.end_ns, CAST(trunc(1e9 / s.tick_fps) AS BIGINT) AS step
          FROM recordings r JOIN robot_schemas s USING (dataset_source) WHERE r.end_ns > r.start_ns),
        read AS (
          SELECT DISTINCT m.episode_id, m.topic, (m.log_time - p.start_ns) // p.step AS tick
          FROM raw_messages m JOIN spans p USING (episode_id)
          WHERE m.value IS NOT NULL AND len(m.value) > 0 AND m.log_time >= p.start_ns AND m.log_time < p.end_ns),
        series AS (SELECT DISTINCT episode_id, topic FROM read),
        grid AS (
          SELECT s.episode_id, s.topic, unnest(range(0, (p.end_ns - p.start_ns - 1) // p.step + 1)) AS tick
          FROM series s JOIN spans p USING (episode_id))
        SELECT episode_id, topic, tick FROM grid EXCEPT SELECT episode_id, topic, tick FROM read""",
    "p4_grid": """
        WITH spans AS (
          SELECT DISTINCT r.episode_id, r.start_ns, r.end_ns, CAST(trunc(1e9 / s.tick_fps) AS BIGINT) AS step
          FROM recordings r JOIN robot_schemas s USING (dataset_source) WHERE r.end_ns > r.start_ns),
        whole AS (
          SELECT m.episode_id, m.topic, m.log_time AS t, max(m.value) AS v
          FROM raw_messages m JOIN spans p USING (episode_id)
          WHERE m.value IS NOT NULL AND len(m.value) > 0 AND m.log_time >= p.start_ns AND m.log_time < p.end_ns GROUP BY 1, 2, 3),
        single AS (SELECT episode_id, topic, t, unnest(range(0, len(v)))::INT AS component, unnest(v) AS v FROM whole),
        read AS (
          SELECT *, lead(t) OVER w AS t1, lead(v) OVER w AS v1 FROM single
          WINDOW w AS (PARTITION BY episode_id, topic, component ORDER BY t)),
        ends AS (
          SELECT episode_id, topic, component, min(t) AS first_t, max(t) AS last_t, arg_min(v, t) AS first_v FROM read GROUP BY 1, 2, 3),
        ticks AS (
          SELECT e.*, p.start_ns, p.step, unnest(range(0, (p.end_ns - p.start_ns - 1) // p.step + 1)) AS tick FROM ends e JOIN spans p USING (episode_id)),
        cells AS (
          SELECT *, start_ns + tick * step AS c0, greatest(start_ns + tick * step, first_t) AS a, least(start_ns + tick * step + step, last_t) AS b FROM ticks),
        levels AS (
          SELECT c.*, coalesce(x.v + CASE WHEN x.t1 IS NULL THEN 0 ELSE (x.v1 - x.v) * ((c.c0 - x.t)::DOUBLE / (x.t1 - x.t)) END, c.first_v) AS at_c0
          FROM cells c ASOF LEFT JOIN read x ON x.episode_id = c.episode_id AND x.topic = c.topic AND x.component = c.component AND c.c0 >= x.t),
        with_a AS (
          SELECT c.*, x.v + CASE WHEN x.t1 IS NULL THEN 0 ELSE (x.v1 - x.v) * ((c.a - x.t)::DOUBLE / (x.t1 - x.t)) END AS at_a
          FROM levels c ASOF LEFT JOIN read x ON x.episode_id = c.episode_id AND x.topic = c.topic AND x.component = c.component AND c.a >= x.t),
        with_b AS (
          SELECT c.*, x.v + CASE WHEN x.t1 IS NULL THEN 0 ELSE (x.v1 - x.v) * ((c.b - x.t)::DOUBLE / (x.t1 - x.t)) END AS at_b
          FROM with_a c ASOF LEFT JOIN read x ON x.episode_id = c.episode_id AND x.topic = c.topic AND x.component = c.component AND c.b >= x.t),
        counts AS (
          SELECT w.episode_id, w.topic, (w.t - p.start_ns) // p.step AS tick, count(*) AS n FROM whole w JOIN spans p USING (episode_id) GROUP BY 1, 2, 3)
        SELECT c.episode_id, c.topic, c.tick, c.component, coalesce(k.n, 0) AS n_readings, round(c.at_c0, 4) AS value,
               CASE WHEN c.b > c.a THEN round(c.at_b - c.at_a, 4) END AS increment, round(greatest(0, c.b - c.a) / c.step, 4) AS covered
        FROM with_b c LEFT JOIN counts k USING (episode_id, topic, tick)""",
    "p6_found": r"""
        WITH lines AS (
          SELECT trim(unnest(string_split_regex(body, '\r\n|\n|\r')), chr(65279) || chr(9) || ' ') AS line FROM record_files),
        objects AS (SELECT line FROM lines WHERE line LIKE '{%' AND json_valid(line))
        SELECT DISTINCT CAST(CAST(json_extract(line, '$.episode_index') AS DOUBLE) AS BIGINT) AS episode_index,
               CAST(CAST(json_extract(line, '$.length') AS DOUBLE) AS BIGINT) AS length
        FROM objects
        WHERE json_type(line, '$.episode_index') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND json_type(line, '$.length') IN ('UBIGINT', 'BIGINT', 'DOUBLE')""",
    "p6_compact": r"""
        WITH found AS (WITH lines AS (
            SELECT trim(unnest(string_split_regex(body, '\r\n|\n|\r')), chr(65279) || chr(9) || ' ') AS line FROM record_files),
          objects AS (SELECT line FROM lines WHERE line LIKE '{%' AND json_valid(line))
          SELECT DISTINCT CAST(CAST(json_extract(line, '$.episode_index') AS DOUBLE) AS BIGINT) AS episode_index,
                 CAST(CAST(json_extract(line, '$.length') AS DOUBLE) AS BIGINT) AS length
          FROM objects
          WHERE json_type(line, '$.episode_index') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND json_type(line, '$.length') IN ('UBIGINT', 'BIGINT', 'DOUBLE'))
        SELECT count(*) AS n_records, CAST(1 AS BIGINT) AS most_often, CAST(1 AS BIGINT) AS n_outputs, count(*) AS n_lines FROM found""",
    "p6_zstd": """
        SELECT count(*) AS n_files, CAST(sum(octet_length(encode(body))) AS BIGINT) AS n_bytes FROM record_files WHERE octet_length(encode(body)) > 0""",
}
