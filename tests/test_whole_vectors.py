"""Queries over vector columns take whole vectors."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_every_list_element_is_a_metric(spark, sf_dir):
    lists = spark.read.parquet(f"{sf_dir}/embeddings.parquet").agg(F.sum(F.size("embedding"))).first()[0]
    assert entry.queries()["indexed_metrics_whole"](spark, sf_dir).count() == lists


def test_chunks_hold_whole_actions(spark, sf_dir):
    widths = spark.read.parquet(f"{sf_dir}/frames.parquet").where("action is not null").groupBy("episode_index").agg(F.max(F.size("action")).alias("wanted"))
    rows = entry.queries()["frame_chunks_whole"](spark, sf_dir)
    steps = rows.select("episode_index", F.size("is_pad").alias("n"), F.explode("chunk").alias("a")).where("a is not null").join(widths, "episode_index")
    assert steps.count() > 0 and steps.where("size(a) <> wanted or n <> 3").count() == 0


def test_zeros_in_chunks_have_no_sign_as_in_sql(spark, tmp_path):
    vectors = [[[-0.0, 1.0, float("nan")]], [[0.0, -0.0], [-0.0, 0.0]], [None], [[-0.5, -0.0], [-0.5, -0.0]], [[]]]
    rows = [(e, f, v) for e in range(12) for f, repeats in enumerate(vectors) for v in repeats]
    spark.createDataFrame(rows, "episode_index long, frame_index long, action array<float>").write.parquet(str(tmp_path / "frames.parquet"))
    found = entry.queries()["frame_chunks_whole"](spark, str(tmp_path))
    assert dict(found.dtypes)["chunk"] == "array<array<float>>"
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW frames AS SELECT * FROM read_parquet('{tmp_path}/frames.parquet/*.parquet')")
        wanted = c.execute(entry.oracle_sql()["frame_chunks_whole"]).fetchall()
    # as text: -0.0 equals 0.0 as a number
    got = sorted(repr(tuple(r)) for r in found.collect())
    assert got and got == sorted(map(repr, wanted))
