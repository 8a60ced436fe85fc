"""Look-ahead action chunks with padding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.runtime import block_keys

BLOCK = 4096


def action_chunks(rows: DataFrame, keys: list[str], index: str, action: str, size: int, block: int = BLOCK) -> DataFrame:
    """Add `chunk` (the actions of this and the next size - 1 rows, the last repeated) and `is_pad` to each row.

    index counts the rows of a series from 0 without gaps; a series is windowed
    in blocks that see size - 1 rows beyond their end, so one long episode
    spreads over many tasks. A null action is an element like any other.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    spread = rows.withColumn("_block", F.explode(block_keys(F.col(index), block, size - 1)))
    ahead = W.partitionBy(*keys, "_block").orderBy(index).rowsBetween(0, size - 1)
    # collect_list skips nulls; a struct around the action keeps them
    taken = spread.withColumn("_c", F.transform(F.collect_list(F.struct(F.col(action).alias("a"))).over(ahead), lambda x: x["a"]))
    own = taken.where(F.expr(f"`{index}` div {block} = _block"))
    padded = F.concat("_c", F.array_repeat(F.element_at("_c", -1), F.lit(size) - F.size("_c")))
    pads = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: i >= F.size("_c"))
    return own.withColumn("chunk", padded).withColumn("is_pad", pads).drop("_c", "_block")


def pad_fraction(chunks: DataFrame) -> DataFrame:
    """Share of padded steps over all chunks, and whether it is more than half."""
    one = chunks.select(F.explode("is_pad").alias("p")).agg(F.avg(F.col("p").cast("int")).alias("pad_fraction"), F.count("*").alias("n_steps"))
    return one.withColumn("mostly_padding", F.coalesce(F.col("pad_fraction") > 0.5, F.lit(False)))
