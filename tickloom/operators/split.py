"""Deterministic split of episodes by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_fraction(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on seed and key alone: the head of SHA-256 of 'seed:key'."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def check_fractions(val: float, test: float) -> None:
    for name, x in (("val", val), ("test", test)):
        if x < 0 or x >= 1:
            raise ValueError(f"{name} fraction must be in [0, 1), not {x}")
    if val + test >= 1:
        raise ValueError("val and test fractions leave nothing to train on")


def split_label(key: Column, val: float, test: float, seed: int = 0) -> Column:
    """'val', 'test' or 'train'; null for a null key. 0 switches a split off."""
    check_fractions(val, test)
    f = hash_fraction(key, seed)
    return F.when(key.isNotNull(), F.when(f < val, "val").when(f < val + test, "test").otherwise("train"))


def only_split(df: DataFrame, key: str, wanted: str, val: float, test: float, seed: int = 0) -> DataFrame:
    """Rows of one split. The predicate uses the key alone, so it moves below windows partitioned by it."""
    return df.where(split_label(F.col(key), val, test, seed) == wanted)


def split_counts(df: DataFrame, key: str, val: float, test: float, seed: int = 0) -> DataFrame:
    """Episodes per split."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().groupBy(split_label(F.col(key), val, test, seed).alias("split")).agg(F.count("*").alias("n_episodes"))


def check_split(counts: DataFrame, val: float, test: float) -> None:
    """Raise if a wanted split is empty. At most three rows are read."""
    have = {r["split"]: r["n_episodes"] for r in counts.limit(3).collect()}
    for name, wanted in (("train", True), ("val", val > 0), ("test", test > 0)):
        if wanted and not have.get(name):
            raise ValueError(f"the {name} split has no episodes")
