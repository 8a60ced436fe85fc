from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tickloom import runtime


def test_tables_in_the_shared_folder(spark):
    df = runtime.materialize(spark.range(10).withColumn("a.b", F.lit(1)), "x")
    assert df.count() == 10 and df.columns == ["id", "a.b"]
    assert runtime.materialize(spark.range(0), "empty").count() == 0
    folder = runtime.tables_dir(spark).removeprefix("file:")
    assert os.path.isdir(folder) and spark.sparkContext.applicationId in folder
    one, other = runtime.materialize(spark.range(3), "one"), runtime.materialize(spark.range(4), "other")
    foreign = folder.rsplit("/", 1)[0] + f"/another-application-{uuid.uuid4().hex}"
    os.makedirs(foreign)
    runtime.drop(one)
    assert other.count() == 4 and not any(x.startswith("one-") for x in os.listdir(folder))
    runtime.drop_materialized(spark)
    assert not os.path.exists(folder) and os.path.exists(foreign)
    os.rmdir(foreign)


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(Session)


def test_lookup_beyond_the_limit_is_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = spark.range(100).withColumn("v", F.lit(1)), spark.range(50)
        plan = lambda **k: runtime.lookup_join(left, right, "id", **k)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan()
        assert "BroadcastHashJoin" not in plan(limit=10)
        assert "BroadcastHashJoin" in plan(limit=2000, size_of=spark.range(1))
        assert runtime.lookup_join(left, right, "id", limit=10).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_block_keys(spark):
    rows = spark.createDataFrame([(x,) for x in (0, 3, 8, 9, 10, 12, 19, 20)], "x bigint")
    got = {r.x: r.b for r in rows.select("x", runtime.block_keys(F.col("x"), 10, 2).alias("b")).collect()}
    assert got == {0: [0], 3: [0], 8: [0, 1], 9: [0, 1], 10: [0, 1], 12: [1], 19: [1, 2], 20: [1, 2]}


def test_operators_reach_workers_without_the_package_there(tmp_path):
    """A direct call in a process whose workers know nothing of this repository."""
    import subprocess
    import sys
    from pathlib import Path

    repo = str(Path(__file__).resolve().parent.parent)
    run = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from tickloom.operators.compaction import consolidate
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
files = spark.createDataFrame([(1, "a"), (2, "b")], "file_id bigint, body string")
print([bytes(r.content) for r in consolidate(files).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", run], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120, check=False)
    assert "b'a\\nb\\n'" in done.stdout, done.stderr[-2000:]
