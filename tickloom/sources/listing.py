"""Listings of files, tasks and runs: JSON and path sources read by Spark itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ordered import numbered, ranged

TASK_INFO = (
    "episode_id bigint, task_name string, init_scene_text string, "
    "label_info struct<action_config: array<struct<start_frame: bigint, end_frame: bigint, action_text: string, skill: string>>>"
)
HISTORY = (
    "timestamp string, run_name string, status string, tasks array<string>, max_episodes_per_task int, v3_root string, num_workers int, use_gpu boolean, policy_type string, "
    "hyperparams map<string,string>, metrics map<string,double>, checkpoint_path string, run_path string, tensorboard_dir string, error string"
)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path and size of all files below root, in no order; contents are not read. See numbered_files()."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path", F.col("length").alias("size"))


def numbered_files(files: DataFrame) -> DataFrame:
    """Files with listing_pos, their place in the order of paths: the same however Spark packs files into partitions."""
    return numbered(ranged(files, ["path"]), [], ["path"], F.col("_bucket"), "listing_pos").drop("_bucket")


def cached_listing(spark: SparkSession, root: str, cache: str, glob: str = "*", refresh: bool = False) -> DataFrame:
    """The listing kept as a table at cache; made anew if it is missing or refresh is set."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    if refresh or not there:
        list_files(spark, root, glob).write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def task_info(spark: SparkSession, root: str) -> DataFrame:
    """task_id and task_name of each 'task_<id>.json', by its first entry; files without entries are skipped."""
    rows = spark.read.schema(TASK_INFO).option("multiLine", True).option("pathGlobFilter", "task_*.json").json(root)
    rows = rows.withColumn("task_id", F.regexp_extract(F.col("_metadata.file_name"), r"task_([0-9]+)\.json$", 1).try_cast("bigint"))
    firsts = rows.where("task_name is not null").withColumn("_at", F.monotonically_increasing_id()).groupBy("task_id").agg(F.min_by("task_name", "_at").alias("task_name"))
    # of files that share a name the later one holds
    return firsts.groupBy("task_name").agg(F.max("task_id").alias("task_id"))


def action_segments(spark: SparkSession, root: str) -> DataFrame:
    """One row per labelled segment of each episode."""
    rows = spark.read.schema(TASK_INFO).option("multiLine", True).option("pathGlobFilter", "task_*.json").json(root)
    return rows.select("episode_id", "task_name", F.inline("label_info.action_config"))


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Runs of a JSON-lines history; blank lines are skipped, broken ones dropped."""
    return spark.read.schema(HISTORY).option("mode", "DROPMALFORMED").json(path).where("timestamp is not null")


def record_run(runs: DataFrame, path: str) -> None:
    """Append runs to a history."""
    runs.write.mode("append").json(path)
