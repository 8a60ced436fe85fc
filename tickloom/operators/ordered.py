"""Running values, row numbers and as-of values over long ordered series.

A plain window puts a whole series into one task. Here a series is cut into
buckets that follow its order; each bucket is scanned by itself, and what one
hands on to the next is a single row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.runtime import materialize

#: Positions of an integer order in one bucket.
BUCKET = 65_536


def int_bucket(order: Column, size: int = BUCKET) -> Column:
    """Bucket of an integer order; follows the order, below zero too."""
    return F.round((order - F.pmod(order, F.lit(size))) / F.lit(size)).cast("bigint")


def text_bucket(order: Column, length: int = 3) -> Column:
    """Bucket of a text order: its first characters, which sort as the text does."""
    return F.substring(order, 1, length)


def spread_bucket(df: DataFrame, order: str, rows: int = BUCKET) -> Column:
    """int_bucket() for numbers of any density: so wide that buckets hold about `rows` rows each. Looks at the numbers once."""
    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    return int_bucket(F.col(order), max(1, (high - low + 1) * rows // n) if n else rows)


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """df with `_bucket`, which follows the order whatever its values: range partitions, as a table, so that every pass sees the same.

    Rows of equal order are in one bucket; texts with a common head are not put together by it.
    """
    return materialize(df.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()), "ranged")


def running(df: DataFrame, keys: list[str], order: list, bucket: Column, name: str, value: Column, how: str = "sum", inclusive: bool = False) -> DataFrame:
    """Add the running sum, min or max of value over the rows before each row (inclusive: and itself).

    order must be total within keys, and bucket must follow its first column.
    Without rows before it, a row gets 0 for sums and null else. Nulls do not count.
    """
    how_of = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    two = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}[how]
    # one struct is the key of the window, the totals and the join: the rows are shuffled once, and null keys are keys
    marked = df.withColumn("_part", _part(keys, bucket)).withColumn("_value", value)
    totals = marked.groupBy("_part").agg(how_of("_value").alias("_total"))
    earlier = W.partitionBy(*(f"_part.{c}" for c in _names(keys))).orderBy("_part._bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select("_part", how_of("_total").over(earlier).alias("_carried"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    joined = marked.withColumn("_local", how_of("_value").over(inside)).join(carried, "_part")
    return joined.withColumn(name, two(F.col("_local"), F.col("_carried"))).select(*(f"`{c}`" for c in df.columns), name)


def _names(keys: list[str]) -> list[str]:
    return [f"k{i}" for i in range(len(keys))]


def _part(keys: list[str], bucket: Column) -> Column:
    return F.struct(*(F.col(f"`{k}`").alias(n) for k, n in zip(keys, _names(keys), strict=True)), bucket.alias("_bucket"))


def numbered(df: DataFrame, keys: list[str], order: list, bucket: Column, name: str = "position") -> DataFrame:
    """Add the zero-based position of each row in its series; order must be total."""
    return running(df, keys, order, bucket, name, F.lit(1).cast("bigint"))


def asof(ticks: DataFrame, events: DataFrame, keys: list[str], time: str, tie: list[str], value: str, bucket_size: int, name: str | None = None, fill_first: bool = True) -> DataFrame:
    """Add to each tick the last event value at or before it; ticks before the first event get the first value.

    keys and time (a bigint) are columns of both tables; of events at one time
    the last in the order of tie holds. Series without events leave null, as do
    null values of events (skipped). Ticks keep all their columns; extra event
    columns are ignored.
    """
    name = name or value
    kind = events.schema[value].dataType
    e = events.where(F.col(value).isNotNull() & F.col(time).isNotNull()).select(
        *keys, F.col(time).alias("_t"), F.lit(0).alias("_tick"), F.struct(*tie).alias("_tie"), F.struct(F.col(value).alias("v")).alias("_event"), F.lit(None).cast(ticks.schema).alias("_row")
    )
    t = ticks.select(
        *keys, F.col(time).alias("_t"), F.lit(1).alias("_tick"), F.lit(None).cast(e.schema["_tie"].dataType).alias("_tie"),
        F.lit(None).cast(e.schema["_event"].dataType).alias("_event"), F.struct(*(F.col(f"`{c}`") for c in ticks.columns)).alias("_row"),
    )
    both = e.unionByName(t).withColumn("_part", _part(keys, int_bucket(F.col("_t"), bucket_size)))
    inside = W.partitionBy("_part").orderBy("_t", "_tick", "_tie").rowsBetween(W.unboundedPreceding, 0)
    local = both.withColumn("_local", F.last("_event", ignorenulls=True).over(inside))
    order = F.struct("_t", "_tie")
    ends = both.groupBy("_part").agg(F.max_by("_event", F.when(F.col("_tick") == 0, order)).alias("_last"), F.min_by("_event", F.when(F.col("_tick") == 0, order)).alias("_first"))
    series = W.partitionBy(*(f"_part.{c}" for c in _names(keys))).orderBy("_part._bucket")
    earlier, later = series.rowsBetween(W.unboundedPreceding, -1), series.rowsBetween(0, W.unboundedFollowing)
    handed = ends.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_before"), F.first("_first", ignorenulls=True).over(later).alias("_after"))
    joined = local.where("_tick = 1").join(handed, "_part")
    found = F.coalesce("_local", "_before", "_after") if fill_first else F.coalesce("_local", "_before")
    return joined.select("_row.*", found["v"].cast(kind).alias(name))
