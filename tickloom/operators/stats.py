"""Statistics of vectors, action chunks and flat images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first n rows by order, or all: the sample that statistics may be taken from."""
    return df if n is None else df.orderBy(order).limit(n)


def _of(elements: DataFrame, by: Column | str) -> DataFrame:
    x = F.col("x").cast("double")
    return elements.where(F.col("x").isNotNull()).groupBy(by).agg(
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), F.count("*").alias("n")
    )


def vector_stats(df: DataFrame, column: str) -> DataFrame:
    """pos, mean, std (population), min, max and n of each vector component. Null vectors and elements do not count."""
    return _of(df.select(F.posexplode(F.col(f"`{column}`")).alias("pos", "x")), "pos")


def valid_action_stats(df: DataFrame, chunk: str = "chunk", is_pad: str = "is_pad") -> DataFrame:
    """The same over all steps of all chunks that are no padding."""
    steps = df.select(F.explode(F.arrays_zip(F.col(chunk).alias("c"), F.col(is_pad).alias("p"))).alias("z")).where("not z.p")
    return _of(steps.select(F.posexplode("z.c").alias("pos", "x")), "pos")


def channel_stats(df: DataFrame, column: str, channels: int) -> DataFrame:
    """The same per channel of flat channel-last images, pooled over images and pixels."""
    elements = df.select(F.posexplode(F.col(f"`{column}`")).alias("i", "x")).withColumn("channel", F.col("i") % channels)
    return _of(elements, "channel")
