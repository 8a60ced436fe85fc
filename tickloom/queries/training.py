"""Training metrics over events (step = event_id + 1, loss = value) and run history over orders; scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import metrics
from tickloom.queries.tables import table
from tickloom.schema import schemas_of

WINDOW = 50
EPOCH = 1730


def _metrics(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (e + 1).alias("step"), F.expr(f"event_id div {EPOCH}").alias("epoch"), F.col("user_id").alias("worker"), F.concat_ws("/", F.lit("train"), "event_type").alias("name"), F.col("value").alias("loss")
    )


def window_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.window_means(_metrics(spark, sf_dir), [], "step", "epoch", "loss", WINDOW).select("epoch", "step", F.round("mean", 6).alias("mean"), "n")


def epoch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.epoch_means(_metrics(spark, sf_dir), [], "epoch", "loss").select("epoch", F.round("mean", 6).alias("mean"), "n")


def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.running_best(_metrics(spark, sf_dir), ["name"], "step", [], "loss").select("name", "step", "loss", "best_before", "improved")


def patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.patience(_metrics(spark, sf_dir), ["name"], "step", "loss", 300).select("name", "step", "improved", "waited", "stop")


def checkpoint_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.retained(_metrics(spark, sf_dir).select("worker", "step", "loss"), ["worker"], "step", "loss", 3)


def retention_improving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.retained_improving(_metrics(spark, sf_dir).select("worker", "step", "loss"), ["worker"], "step", "loss", 3)


def best_val_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _metrics(spark, sf_dir).withColumn("kind", F.when(F.col("name") == "train/view", "val").when(F.col("name") == "train/error", "test").otherwise("window"))
    best = metrics.running_best(metrics.owning_reports(kinds, "kind", True), ["kind"], "step", [], "loss")
    return best.where("improved").select("step", "loss", "best_before")


def eval_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _metrics(spark, sf_dir).groupBy("epoch", "worker", "name").agg(F.sum("loss").alias("total"), F.count("*").alias("n"))
    return metrics.gathered(sums, ["epoch"], "name", "total", "n").select("epoch", "name", F.round("mean", 6).alias("mean"), "n")


def min_rank_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.common_batches(_metrics(spark, sf_dir), "worker", 1000)


def resume_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir).withColumn("complete", F.when(F.col("loss") > 20, True).when(F.col("loss") > 5, False))
    return metrics.resume_epoch(rows, ["worker"], "step", "epoch", "complete")


def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What falls due at each step: a log line, a validation pass, a prediction."""
    s = F.col("step")
    return _metrics(spark, sf_dir).select("step", metrics.due(s, 10).alias("log"), metrics.due(s, 500).alias("validate"), metrics.due(s, 750).alias("predict"))


def metric_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scalars.glob_filter(F.col("name"), ["train/*", "loss"], ["*/s*", "*/[!a-d]rr?r"])
    return _metrics(spark, sf_dir).where(kept).groupBy("name").agg(F.count("*").alias("n"))


def metric_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", metrics.metric_name(F.lit("val"), F.col("event_type")).alias("name"))


def indexed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "embeddings").select("vec_id", F.lit("loss_per_dim").alias("name"), F.slice("embedding", 1, 5).cast("array<double>").alias("values"))
    return metrics.indexed_metrics(lists, ["vec_id"], "name", "values")


def indexed_metrics_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of every list."""
    lists = table(spark, sf_dir, "embeddings").select("vec_id", F.lit("loss_per_dim").alias("name"), F.col("embedding").cast("array<double>").alias("values"))
    return metrics.indexed_metrics(lists, ["vec_id"], "name", "values")


def perf_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per worker: share of waiting (view) in waiting, preparing (click) and computing (error), and samples a second."""
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("name") == f"train/{kind}", F.col("loss"))), F.lit(0.0))
    one = _metrics(spark, sf_dir).groupBy("worker").agg(total("view").alias("w"), total("click").alias("p"), total("error").alias("c"), F.count("*").alias("n"))
    wall = F.col("w") + F.col("p") + F.col("c")
    return one.select(
        "worker", F.round(metrics.share(F.col("w"), F.col("p"), F.col("c")), 6).alias("io_bound_fraction"), F.round(metrics.per_second(F.col("n"), 8, 4, wall), 6).alias("samples_per_sec"),
        metrics.effective_batch(F.lit(8), F.lit(2), F.lit(4)).cast("bigint").alias("effective_batch"),
    )


def memory_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes for converting an episode of each source at 224 x 224, cameras at once and one by one."""
    n, side = F.size("camera_keys"), F.lit(224)
    return table(spark, sf_dir, "robot_schemas").select(
        "dataset_source", metrics.episode_bytes(side, side, n, True).alias("parallel"), metrics.episode_bytes(side, side, n, False).alias("sequential")
    )


def vector_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared widths of each source and those of its schema, the sums of its components'."""
    declared = table(spark, sf_dir, "robot_schemas")
    sums = [(s.dataset_source, s.state_dim, s.action_dim) for s in schemas_of(declared).values()]
    return declared.select("dataset_source", "state_dim", "action_dim").join(spark.createDataFrame(sums, "dataset_source string, state_sum int, action_sum int"), "dataset_source")


def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' sources read as URIs of different kinds."""
    kinds = F.when(F.col("lang") == "en", F.concat(F.lit("hf://datasets/"), "source")).when(F.col("lang") == "de", F.concat(F.lit("hf://"), "source")).when(F.col("lang") == "es", F.concat(F.lit("s3://"), "source")).otherwise(F.col("source"))
    rows = table(spark, sf_dir, "documents").select("doc_id", kinds.alias("uri"))
    return rows.select("doc_id", scalars.uri_scheme(F.col("uri")).alias("scheme"), scalars.hub_uri(F.col("uri"))["repo_type"].alias("repo_type"), scalars.hub_uri(F.col("uri"))["repo_id"].alias("repo_id"))


def safe_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest paths, some climbing above their root."""
    p = F.col("rel_path")
    tried = F.when(F.col("task_index").isNull(), F.concat(F.lit("/"), p)).when(F.col("task").isNull(), F.concat(F.lit("a/../../"), p)).otherwise(F.concat(F.lit("a/../"), p))
    return table(spark, sf_dir, "manifest").select("rel_path", tried.alias("path")).distinct().select("path", scalars.is_safe_path(F.col("path")).alias("safe"))


def kv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in props, by JSON and as 'key=value'."""
    k = F.get_json_object("props", "$.k")
    pair = scalars.key_value(F.concat(F.lit("k ="), k))
    return table(spark, sf_dir, "events").select("event_id", pair["key"].alias("key"), pair["value"].try_cast("bigint").alias("value"), scalars.span_pair(F.concat_ws(":", F.lit("40"), k))["last"].alias("upto"))


def codec_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_camera").groupBy(scalars.codec(F.upper("format")).alias("codec")).agg(F.count("*").alias("n"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data and video paths of the episodes of a dataset."""
    e = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.data_path(F.expr("o_orderkey div 1000"), e).alias("data_path"), scalars.video_path(F.lit("observation.images.top"), e).alias("video_path"))


def history_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100000).alias("loss"))
    tail = metrics.history_tail(runs, "timestamp", ["o_orderkey"], 20)
    return tail.select("o_orderkey", scalars.history_line(F.col("timestamp"), F.col("status"), F.col("loss")).alias("line"))


QUERIES = {
    f.__name__: f
    for f in (
        window_loss, epoch_loss, running_best, patience, checkpoint_retention, retention_improving, best_val_loss, eval_gather, min_rank_batches, resume_epoch, cadence,
        metric_filter, metric_prefix, indexed_metrics, indexed_metrics_whole, perf_ratios, memory_estimate, vector_widths, uri_parse, safe_path, kv_parse, codec_map, file_names, history_tail,
    )
}

_M = f"m AS (SELECT event_id + 1 AS step, event_id // {EPOCH} AS epoch, user_id AS worker, 'train/' || event_type AS name, value AS loss FROM events)"
_BEST = f"""{_M}, b AS (SELECT *, min(loss) OVER (PARTITION BY name ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM m),
  best AS (SELECT *, coalesce(loss < best_before, true) AS improved FROM b)"""

SQL = {
    "window_loss": f"""WITH {_M}, w AS (SELECT epoch, CAST(ceil(step / {WINDOW}.0) AS BIGINT) * {WINDOW} AS e, sum(loss) AS s, count(loss) AS n, max(step) AS last FROM m GROUP BY 1, 2)
        SELECT epoch, e AS step, round(s / greatest(n, 1), 6) AS mean, n FROM w WHERE last = e""",
    "epoch_loss": f"WITH {_M} SELECT epoch, round(sum(loss) / greatest(count(loss), 1), 6) AS mean, count(loss) AS n FROM m GROUP BY 1",
    "running_best": f"WITH {_BEST} SELECT name, step, loss, best_before, improved FROM best",
    "patience": f"""WITH {_BEST}, n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY step) AS n FROM best),
        w AS (SELECT *, n - coalesce(max(CASE WHEN improved THEN n END) OVER (PARTITION BY name ORDER BY step ROWS UNBOUNDED PRECEDING), 0) AS waited FROM n)
        SELECT name, step, improved, waited, waited >= 300 AS stop FROM w""",
    "checkpoint_retention": f"""WITH {_M}, r AS (SELECT worker, step, loss, row_number() OVER (PARTITION BY worker ORDER BY loss, step) AS a, row_number() OVER (PARTITION BY worker ORDER BY step DESC) AS b FROM m)
        SELECT worker, step, loss FROM r WHERE a <= 3 OR b = 1""",
    "retention_improving": f"""WITH {_M}, b AS (SELECT *, min(loss) OVER (PARTITION BY worker ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bb FROM m),
        r AS (SELECT worker, step, loss, row_number() OVER (PARTITION BY worker ORDER BY step DESC) AS a FROM b WHERE coalesce(loss < bb, true))
        SELECT worker, step, loss FROM r WHERE a <= 3""",
    "best_val_loss": f"WITH {_BEST} SELECT step, loss, best_before FROM best WHERE name = 'train/view' AND improved",
    "eval_gather": f"WITH {_M} SELECT epoch, name, round(sum(loss) / count(*), 6) AS mean, count(*) AS n FROM m GROUP BY 1, 2",
    "min_rank_batches": f"WITH {_M} SELECT least(min(n), 1000) AS n_batches FROM (SELECT worker, count(*) AS n FROM m GROUP BY 1)",
    "resume_epoch": f"""WITH {_M}, c AS (SELECT *, CASE WHEN loss > 20 THEN true WHEN loss > 5 THEN false END AS complete FROM m),
        l AS (SELECT worker, arg_max({{'e': epoch, 'c': coalesce(complete, true)}}, step) AS l FROM c GROUP BY 1)
        SELECT worker, CASE WHEN l.c THEN l.e + 1 ELSE l.e END AS resume_epoch FROM l""",
    "cadence": f"WITH {_M} SELECT step, step % 10 = 0 AS log, step % 500 = 0 AS validate, step % 750 = 0 AS predict FROM m",
    "metric_filter": f"""WITH {_M} SELECT name, count(*) AS n FROM m
        WHERE (name GLOB 'train/*' OR name = 'loss') AND NOT (regexp_full_match(name, '.*/s.*') OR regexp_full_match(name, '.*/[^a-d]rr.r')) GROUP BY 1""",
    "metric_prefix": "SELECT event_id, 'val/' || event_type AS name FROM events",
    "indexed_metrics": "SELECT vec_id, 'loss_per_dim_' || k AS name, embedding[k + 1]::DOUBLE AS value FROM embeddings CROSS JOIN (SELECT unnest(range(0, 5)) AS k)",
    "indexed_metrics_whole": """WITH k AS (SELECT unnest(range(0, (SELECT max(len(embedding)) FROM embeddings))) AS k)
        SELECT vec_id, 'loss_per_dim_' || k AS name, embedding[k + 1]::DOUBLE AS value FROM embeddings JOIN k ON k.k < len(embedding)""",
    "perf_ratios": f"""WITH {_M}, o AS (SELECT worker, coalesce(sum(loss) FILTER (WHERE name = 'train/view'), 0) AS w, coalesce(sum(loss) FILTER (WHERE name = 'train/click'), 0) AS p,
          coalesce(sum(loss) FILTER (WHERE name = 'train/error'), 0) AS c, count(*) AS n FROM m GROUP BY 1)
        SELECT worker, round(CASE WHEN w + p + c > 0 THEN w / (w + p + c) ELSE 0 END, 6) AS io_bound_fraction,
          round(CASE WHEN w + p + c > 0 THEN n * 32 / (w + p + c) ELSE 0 END, 6) AS samples_per_sec, 64::BIGINT AS effective_batch FROM o""",
    "memory_estimate": """SELECT dataset_source, CAST(trunc((224 * 224 * 3)::BIGINT * 6000 * (2 * len(camera_keys)) * 1.3::DOUBLE) AS BIGINT) AS parallel,
          CAST(trunc((224 * 224 * 3)::BIGINT * 6000 * (2 + len(camera_keys) - 1) * 1.3::DOUBLE) AS BIGINT) AS sequential FROM robot_schemas""",
    "vector_widths": """SELECT dataset_source, state_dim, action_dim, list_sum(list_transform(state_components, lambda x: x.dim))::INT AS state_sum,
          list_sum(list_transform(action_components, lambda x: x.dim))::INT AS action_sum FROM robot_schemas""",
    "uri_parse": """SELECT doc_id, CASE WHEN lang = 'en' OR lang = 'de' THEN 'hf' WHEN lang = 'es' THEN 's3' WHEN source IS NOT NULL THEN 'file' END AS scheme,
          CASE WHEN lang = 'en' THEN 'dataset' WHEN lang = 'de' THEN 'model' END AS repo_type, CASE WHEN lang IN ('en', 'de') THEN source END AS repo_id FROM documents""",
    "safe_path": """SELECT DISTINCT CASE WHEN task_index IS NULL THEN '/' || rel_path WHEN task IS NULL THEN 'a/../../' || rel_path ELSE 'a/../' || rel_path END AS path,
          task_index IS NOT NULL AND task IS NOT NULL AS safe FROM manifest""",
    "kv_parse": """WITH p AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)
        SELECT event_id, 'k' AS key, k::BIGINT AS value, CASE WHEN k::BIGINT > 40 THEN k::BIGINT END AS upto FROM p""",
    "codec_map": """SELECT CASE WHEN lower(format) IN ('h264', 'avc', 'avc1') THEN 'h264' WHEN lower(format) IN ('h265', 'hevc', 'hvc1') THEN 'hevc' END AS codec, count(*) AS n FROM raw_camera GROUP BY 1""",
    "file_names": """SELECT o_orderkey, printf('data/chunk-%03d/file-%06d.parquet', o_orderkey // 1000, o_orderkey) AS data_path,
          printf('videos/observation.images.top/chunk-000/file-%06d.mp4', o_orderkey) AS video_path FROM orders""",
    "history_tail": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || ' ' || o_orderstatus || ' ' ||
          CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE printf('%.4f', o_totalprice / 100000) END AS line
        FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20)""",
}
