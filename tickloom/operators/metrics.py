"""Training metrics: step windows, running best, patience, retention and ratios.

Every running value goes through ordered.running(), so that a run of any number
of reports is scanned in stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.catalog import first_n
from tickloom.operators.ordered import int_bucket, running
from tickloom.runtime import lookup_join


def window_means(metrics: DataFrame, keys: list[str], step: str, epoch: str, value: str, size: int) -> DataFrame:
    """Mean per window of `size` steps, reported at its last step.

    Sums begin anew at each window's end and at each epoch, so a window that an
    epoch cuts short is reported only if it holds a multiple of size.
    """
    at = F.ceil(F.col(step) / F.lit(size)).cast("bigint") * size
    grouped = metrics.groupBy(*keys, epoch, at.alias("_end")).agg(F.sum(value).alias("_s"), F.count(value).alias("n"), F.max(step).alias("_last"))
    return grouped.where("_last = _end").select(*keys, epoch, F.col("_end").alias(step), (F.col("_s") / F.greatest(F.col("n"), F.lit(1))).alias("mean"), "n")


def epoch_means(metrics: DataFrame, keys: list[str], epoch: str, value: str) -> DataFrame:
    """Mean per epoch; an epoch without values has mean 0."""
    one = metrics.groupBy(*keys, epoch).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("_s"), F.count(value).alias("n"))
    return one.select(*keys, epoch, (F.col("_s") / F.greatest(F.col("n"), F.lit(1))).alias("mean"), "n")


def running_best(reports: DataFrame, keys: list[str], step: str, tie: list, value: str) -> DataFrame:
    """Add best_before (least value of earlier reports) and improved (value strictly less, or the first)."""
    out = running(reports, keys, [step, *tie], int_bucket(F.col(step)), "best_before", F.col(value), "min")
    return out.withColumn("improved", F.coalesce(F.col(value) < F.col("best_before"), F.col(value).isNotNull()))


def patience(reports: DataFrame, keys: list[str], step: str, value: str, limit: int) -> DataFrame:
    """Add waited (window reports since the last improvement) and stop (waited >= limit).

    Rows with is_window false (epoch reports) move the best, but do not count;
    without that column every row is a window.
    """
    window = F.col("is_window") if "is_window" in reports.columns else F.lit(True)
    best = running_best(reports, keys, step, [F.desc("is_window")] if "is_window" in reports.columns else [], value)
    order = [step, F.desc("is_window")] if "is_window" in reports.columns else [step]
    counted = running(best, keys, order, int_bucket(F.col(step)), "_n", F.when(window, 1).otherwise(0), "sum", inclusive=True)
    reset = F.when(window & F.col("improved"), F.col("_n"))
    marked = running(counted, keys, order, int_bucket(F.col(step)), "_at", reset, "max", inclusive=True)
    waited = F.col("_n") - F.coalesce("_at", F.lit(0))
    return marked.withColumn("waited", waited.cast("bigint")).withColumn("stop", F.col("waited") >= limit).drop("_n", "_at")


def retained(checkpoints: DataFrame, keys: list[str], step: str, loss: str, k: int) -> DataFrame:
    """Checkpoints to keep: the k of least loss (earlier first among equals) and the latest."""
    best = first_n(checkpoints, keys, [F.col(loss).asc_nulls_last(), step], k).drop("place")
    latest = first_n(checkpoints, keys, [F.desc(step)], 1).drop("place")
    return best.unionByName(latest).distinct()


def retained_improving(checkpoints: DataFrame, keys: list[str], step: str, loss: str, k: int) -> DataFrame:
    """The last k checkpoints that improved on all before them."""
    return first_n(running_best(checkpoints, keys, step, [], loss).where("improved"), keys, [F.desc(step)], k).drop("place", "best_before", "improved")


def owning_reports(reports: DataFrame, kind: str, val_active: bool) -> DataFrame:
    """Reports that decide which checkpoint is best: validation ones if there is such a split, else windows and epochs. Test reports never."""
    return reports.where(F.col(kind) == "val") if val_active else reports.where(F.col(kind).isin("window", "epoch"))


def gathered(stats: DataFrame, keys: list[str], name: str, total: str, count: str) -> DataFrame:
    """Means over all workers from their sums and counts; names that only some workers report count those."""
    one = stats.groupBy(*keys, name).agg(F.sum(total).alias("_s"), F.sum(count).alias("n"))
    return one.select(*keys, name, (F.col("_s") / F.greatest(F.col("n"), F.lit(1))).alias("mean"), "n")


def common_batches(batches: DataFrame, rank: str, cap: int | None = None) -> DataFrame:
    """How many batches every rank consumes: those of the rank that has fewest, at most cap."""
    least = batches.groupBy(rank).agg(F.count("*").alias("_n")).agg(F.coalesce(F.min("_n"), F.lit(0)).cast("bigint").alias("n_batches"))
    return least if cap is None else least.withColumn("n_batches", F.least("n_batches", F.lit(cap).cast("bigint")))


def led(decisions: DataFrame, ranks: DataFrame, keys: list[str], rank: str, leader: int = 0) -> DataFrame:
    """Every rank with the decision of the leader."""
    return lookup_join(ranks, decisions.where(F.col(rank) == leader).drop(rank), keys, "left", size_of=decisions)


def due(step: Column, every: int) -> Column:
    """Whether something that is done every so many steps falls due at this one; never if every is 0."""
    return step % every == 0 if every > 0 else F.lit(False)


def resume_epoch(checkpoints: DataFrame, keys: list[str], step: str, epoch: str, complete: str) -> DataFrame:
    """Epoch to go on with: that of the latest checkpoint if it was cut short, else the next. Unknown counts as complete."""
    last = checkpoints.groupBy(*keys).agg(F.max_by(F.struct(F.col(epoch).alias("e"), F.coalesce(F.col(complete), F.lit(True)).alias("c")), step).alias("l"))
    return last.select(*keys, F.when(F.col("l.c"), F.col("l.e") + 1).otherwise(F.col("l.e")).alias("resume_epoch"))


def share(part: Column, *rest: Column) -> Column:
    """part / (part + rest), 0 where the sum is 0."""
    whole = part
    for x in rest:
        whole = whole + x
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def per_second(n: Column, batch: int, world: int, wall: Column) -> Column:
    return F.when(wall > 0, n * batch * world / wall).otherwise(F.lit(0.0))


def effective_batch(batch: Column, accumulation: Column, world: Column) -> Column:
    return batch * accumulation * world


def episode_bytes(height: Column, width: Column, cameras: Column, parallel: bool, frames: int = 6000, margin: float = 1.3) -> Column:
    """Memory that converting one episode takes: decoded and resized frames of all cameras, or of one at a time."""
    held = 2 * cameras if parallel else 2 + (cameras - 1)
    return (height.cast("bigint") * width * 3 * frames * held * margin).cast("bigint")


def concurrency(cpus: int, cpus_per_episode: int, memory: int, episode: int) -> int:
    """Episodes converted at once: as CPUs and memory allow, at least one."""
    return max(1, min(cpus // cpus_per_episode, memory // max(1, episode)))


def metric_name(prefix: Column, name: Column) -> Column:
    return F.concat_ws("/", prefix, name)


def indexed_metrics(df: DataFrame, keys: list[str], name: str, values: str) -> DataFrame:
    """List-valued metrics as scalars name_0, name_1, ..."""
    return df.select(*keys, F.col(name).alias("_n"), F.posexplode(values).alias("_i", "value")).select(*keys, F.concat_ws("_", "_n", "_i").alias(name), "value")


def history_tail(history: DataFrame, time: str, tie: list[str], n: int) -> DataFrame:
    """The last n runs, oldest first."""
    return history.orderBy(F.desc(time), *(F.desc(t) for t in tie)).limit(n).orderBy(time, *tie)


def metric_rows(df: DataFrame, prefix: str, step: str, names: list[str], keys: list[str] = ()) -> DataFrame:
    """Wide reports as long rows: keys, step, 'prefix/name', value. Nulls are not reported. For sinks that append."""
    pairs = F.array(*(F.struct(F.lit(f"{prefix}/{n}").alias("name"), F.col(n).cast("double").alias("value")) for n in names))
    return df.select(*keys, F.col(step).alias("step"), F.inline(pairs)).where("value is not null")
