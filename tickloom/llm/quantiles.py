"""Percentiles of very large numeric columns by deterministic buffer collapsing.

A sketch holds sorted buffers of k numbers; a buffer of level l stands for
k * fan_in**l readings. As soon as a level holds fan_in buffers they are merged
and every fan_in-th number, from the middle of the first step on, forms one
buffer of the next level. Each such collapse moves a rank by at most
(fan_in // 2) * fan_in**l, and the sketch adds that up: `rank_error` is a proven
bound for every answer, not an estimate. Sketches of parts, days or earlier
runs merge by pooling their buffers, with their bounds added.

Partial sketches are made where the data lie; only buffers are shuffled, and
merging goes through rounds of a bounded fan-in, so no group meets in one task
unless it is already small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tickloom.operators.frames import frame_blocks, unpack
from tickloom.runtime import ship

K = 1024
FAN_IN = 4
#: Bytes of sketches that a task holds before they are given out; partial sketches merge later anyway.
HELD_BYTES = 64 << 20
#: Partial sketches of one group that a task of a merge round takes.
MERGE_FAN_IN = 32


def buffer_size(error: float, n: int, fan_in: int = FAN_IN) -> int:
    """The least power of two k with which sketches of n readings stay within error, a share of n.

    A collapse of level l moves ranks by (fan_in // 2) * fan_in**l and there are
    n / (k * fan_in**(l + 1)) of them, so each of the levels adds
    (fan_in // 2) / fan_in / k of n.
    """
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    k = 16
    while np.ceil(np.log(max(n, 2) / k) / np.log(fan_in)) * (fan_in // 2) / fan_in / k > error:
        k *= 2
    return k


class Sketch:
    """Mergeable quantile sketch with a proven rank error."""

    __slots__ = ("err", "fan_in", "flip", "k", "levels", "loose", "loose_n", "n")

    def __init__(self, k: int = K, fan_in: int = FAN_IN):
        if k < 1 or fan_in < 2:
            raise ValueError("k must be at least 1 and fan_in at least 2")
        self.k, self.fan_in = k, fan_in
        self.n, self.err, self.flip = 0, 0, 0
        self.levels: dict[int, list[np.ndarray]] = {}
        self.loose: list[np.ndarray] = []
        self.loose_n = 0

    def add(self, values: np.ndarray) -> None:
        """Add finite numbers."""
        if len(values):
            self.n += len(values)
            self._take(values)

    def _take(self, values: np.ndarray) -> None:
        self.loose.append(values)
        self.loose_n += len(values)
        if self.loose_n >= self.k:
            pool = np.concatenate(self.loose)
            whole = len(pool) // self.k * self.k
            for i in range(0, whole, self.k):
                self._push(0, np.sort(pool[i : i + self.k]))
            self.loose, self.loose_n = [pool[whole:]], len(pool) - whole

    def _push(self, level: int, buffer: np.ndarray) -> None:
        row = self.levels.setdefault(level, [])
        row.append(buffer)
        if len(row) == self.fan_in:
            self.levels[level] = []
            merged = np.sort(np.concatenate(row), kind="stable")
            # an even step has two middles; taking them in turn keeps the errors from adding up one way
            first = (self.fan_in - 1 + self.flip) // 2 if self.fan_in % 2 == 0 else self.fan_in // 2
            self.flip ^= 1
            self.err += self.fan_in // 2 * self.fan_in**level
            self._push(level + 1, merged[first :: self.fan_in])

    def take(self, n: int, err: int, level: int, values: np.ndarray) -> None:
        """Merge one stored part of another sketch with the same k and fan_in; level -1 holds loose readings."""
        self.n += n
        self.err += err
        if level < 0:
            if len(values):
                self._take(values)
        else:
            self._push(level, values)

    @property
    def bytes(self) -> int:
        """What its numbers take, and about what it takes besides."""
        return 8 * self.loose_n + sum(len(row) for row in self.levels.values()) * (8 * self.k + 200) + 1000

    def parts(self) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """What take() wants, part by part. Counts and error stand with the first."""
        yield self.n, self.err, -1, np.concatenate(self.loose) if self.loose else np.empty(0)
        for level, buffers in self.levels.items():
            for buffer in buffers:
                yield 0, 0, level, buffer

    def quantiles(self, shares: list[float]) -> np.ndarray:
        """Readings whose rank is within err of ceil(share * n), ranks from 1; NaN without readings."""
        if not self.n:
            return np.full(len(shares), np.nan)
        values = [np.concatenate(self.loose) if self.loose else np.empty(0)]
        weights = [np.ones(len(values[0]), np.int64)]
        for level, buffers in self.levels.items():
            for buffer in buffers:
                values.append(buffer)
                weights.append(np.full(len(buffer), self.fan_in**level, np.int64))
        pool, weight = np.concatenate(values), np.concatenate(weights)
        order = np.argsort(pool, kind="stable")
        rank = np.cumsum(weight[order])
        wanted = [min(max(1, int(np.ceil(q * self.n))), self.n) for q in shares]
        return pool[order][np.searchsorted(rank, wanted, side="left")]


PARTS = "part bigint, n bigint, err bigint, level int, readings binary"


def _part_rows(keys: list[tuple], names: list[str], types: list[pa.DataType], part: int, sketches: list[Sketch], dtype: str) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(len(names) + 5)]
    for key, sketch in zip(keys, sketches, strict=True):
        for n, err, level, values in sketch.parts():
            for column, x in zip(columns, (*key, part, n, err, level, values.astype(dtype).tobytes()), strict=True):
                column.append(x)
    kinds = [*types, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*names, "part", "n", "err", "level", "readings"])


def sketch_batches(batches: Iterator[pa.RecordBatch], feed: Callable, names: list[str], types: list[pa.DataType], k: int, fan_in: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """Partial sketches of a partition. feed(batch) gives (key tuple, finite numbers) pairs."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    held: dict[tuple, Sketch] = {}
    size = 0
    for batch in batches:
        for key, values in feed(batch):
            sketch = held.get(key)
            if sketch is None:
                sketch = held[key] = Sketch(k, fan_in)
                size += sketch.bytes
            before = sketch.bytes
            sketch.add(values)
            size += sketch.bytes - before
            if size > HELD_BYTES:
                yield from _given_out(held, names, types, part, dtype)
                held, size = {}, 0
    yield from _given_out(held, names, types, part, dtype)


def _given_out(held: dict[tuple, Sketch], names: list[str], types: list[pa.DataType], part: int, dtype: str) -> Iterator[pa.RecordBatch]:
    keys = list(held)
    for i in range(0, len(keys), 500):
        yield _part_rows(keys[i : i + 500], names, types, part, [held[x] for x in keys[i : i + 500]], dtype)


def _merged(batches: Iterator[pa.RecordBatch], names: list[str], k: int, fan_in: int, dtype: str) -> Iterator[tuple[tuple, int, Sketch]]:
    """Sketches of a partition sorted by names and part; parts of one key follow one another."""
    now, sketch = None, Sketch(k, fan_in)
    for batch in batches:
        keys = list(zip(*(batch[c].to_pylist() for c in (*names, "part")), strict=True))
        n, err, level = (batch[c].to_pylist() for c in ("n", "err", "level"))
        for i, key in enumerate(keys):
            if key != now:
                if now is not None:
                    yield now[:-1], now[-1], sketch
                now, sketch = key, Sketch(k, fan_in)
            sketch.take(n[i], err[i], level[i], np.frombuffer(batch["readings"][i].as_buffer(), dtype))
    if now is not None:
        yield now[:-1], now[-1], sketch


def _arrow_types(df: DataFrame, names: list[str]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(df.schema[c].dataType) for c in names]


def _columns(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def merge_sketches(parts: DataFrame, keys: list[str], n_parts: int, k: int = K, fan_in: int = FAN_IN, until: int = 1, dtype: str = "f8") -> DataFrame:
    """Merge partial sketches by keys until at most `until` per key are left.

    n_parts bounds the values of `part` per key; dtype is that of the readings. Each round sends at most
    MERGE_FAN_IN of them to one place; a task holds one sketch at a time.
    """
    ship(parts.sparkSession)
    types = _arrow_types(parts, keys)
    schema = f"{_columns(parts, keys)}, {PARTS}"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part, sketch in _merged(batches, keys, k, fan_in, dtype):
            yield _part_rows([key], keys, types, part, [sketch], dtype)

    while n_parts > until:
        n_parts = max(until, -(-n_parts // MERGE_FAN_IN))
        salted = parts.withColumn("part", F.pmod("part", F.lit(n_parts)).cast("bigint"))
        parts = salted.repartition(*keys, "part").sortWithinPartitions(*keys, "part").mapInArrow(merge, schema)
    return parts


def read_quantiles(parts: DataFrame, keys: list[str], shares: list[float], k: int = K, fan_in: int = FAN_IN, dtype: str = "f8") -> DataFrame:
    """Percentiles of the keys' merged sketches: keys, q, value, n, rank_error (ranks) and error_share (of n).

    At most MERGE_FAN_IN partial sketches per key may be left in parts.
    """
    types = _arrow_types(parts, keys)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, sketch in _merged(batches, keys, k, fan_in, dtype):
            found = sketch.quantiles(shares)
            rows = [pa.array([x] * len(shares), t) for x, t in zip(key, types, strict=True)]
            numbers = [shares, found.astype(np.float64).tolist(), [sketch.n] * len(shares), [sketch.err] * len(shares), [sketch.err / max(1, sketch.n)] * len(shares)]
            kinds = [pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(rows + [pa.array(x, t) for x, t in zip(numbers, kinds, strict=True)], names=[*keys, "q", "value", "n", "rank_error", "error_share"])

    together = parts.withColumn("part", F.lit(0).cast("bigint")).repartition(*keys).sortWithinPartitions(*keys, "part")
    return together.mapInArrow(read, f"{_columns(parts, keys)}, q double, value double, n bigint, rank_error bigint, error_share double")


def sketch_column(df: DataFrame, keys: list[str], value: str, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Partial sketches of a numeric column, per key and partition. Null, NaN and infinite readings are not counted."""
    ship(df.sparkSession)
    names = list(keys)
    types = _arrow_types(df, names)

    def feed(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
        table = pa.Table.from_batches([batch]).group_by(names, use_threads=False).aggregate([("_value", "list")])
        for row, values in zip(table.select(names).to_pylist(), table["_value_list"], strict=True):
            x = np.asarray(values.values.to_numpy(zero_copy_only=False), np.float64)
            yield tuple(row[c] for c in names), x[np.isfinite(x)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sketch_batches(batches, feed, names, types, k, fan_in, "f8")

    return df.select(*names, F.col(value).cast("double").alias("_value")).mapInArrow(sketch, f"{_columns(df, names)}, {PARTS}")


def quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float], k: int = K, fan_in: int = FAN_IN, n_parts: int | None = None) -> DataFrame:
    """Percentiles of value per key, with a proven bound on the rank error.

    keys must not be empty; a null key is a key like any other, and a key may
    have any name but those of the results. Groups without a finite reading come
    out with n = 0 and NaN. n_parts bounds the partitions of df and is counted if
    not given. Extra columns are ignored.
    """
    if not keys or set(keys) & {"q", "value", "n", "rank_error", "error_share"}:
        raise ValueError(f"keys must be given and differ from the names of the results: {keys}")
    n_parts = n_parts or df.rdd.getNumPartitions()
    names = [f"k{i}" for i in range(len(keys))]
    plain = df.select(*(F.col(f"`{key}`").alias(n) for key, n in zip(keys, names, strict=True)), F.col(f"`{value}`").alias("v"))
    parts = merge_sketches(sketch_column(plain, names, "v", k, fan_in), names, n_parts, k, fan_in, MERGE_FAN_IN)
    return read_quantiles(parts, names, shares, k, fan_in).withColumnsRenamed(dict(zip(names, keys, strict=True)))


FRAME_KEYS = ["dataset_source", "feature", "component"]
#: Readings of frames are 32-bit numbers; their sketches are kept as such.
FRAME_TYPE = "f4"
SHARES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def frame_sketches(frames: DataFrame, manifest: DataFrame, by_day: bool = False, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Partial sketches of every component of observation.state and action, per source (and recording day)."""
    names = ["dataset_source", "day", "feature", "component"] if by_day else FRAME_KEYS
    types = [pa.string(), pa.date32(), pa.string(), pa.int64()] if by_day else [pa.string(), pa.string(), pa.int64()]

    def feed(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
        stacks: dict[tuple, list[np.ndarray]] = {}
        for source, day, _, _, _, features in unpack(batch):
            for feature, x in features.items():
                stacks.setdefault((source, day if by_day else None, feature, x.shape[1]), []).append(x)
        for (source, day, feature, width), found in stacks.items():
            columns = np.ascontiguousarray(np.concatenate(found).T)
            finite = np.isfinite(columns)
            for c in range(width):
                x = columns[c] if finite[c].all() else columns[c][finite[c]]
                yield ((source, day, feature, c) if by_day else (source, feature, c)), x

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sketch_batches(batches, feed, names, types, k, fan_in, FRAME_TYPE)

    schema = "dataset_source string, " + "day date, " * by_day + "feature string, component bigint, " + PARTS
    return frame_blocks(frames, manifest, halo=0, by_day=by_day).mapInArrow(sketch, schema)


def _n_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frame_percentiles(frames: DataFrame, manifest: DataFrame, shares: list[float] | None = None, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Percentiles of the finite readings per dataset_source, feature and component.

    k is the length of the buffers; buffer_size() gives the one for a wanted
    error, and rank_error in the result is what was reached. Repeated frames count once; null vectors and NaN or infinite readings do
    not count. Columns as of read_quantiles(). Empty frames give no rows.
    """
    parts = merge_sketches(frame_sketches(frames, manifest, False, k, fan_in), FRAME_KEYS, _n_parts(frames), k, fan_in, MERGE_FAN_IN, FRAME_TYPE)
    return read_quantiles(parts, FRAME_KEYS, shares or SHARES, k, fan_in, FRAME_TYPE)


def day_sketches(frames: DataFrame, manifest: DataFrame, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Sketches per source, recording day and component: a table to keep and to merge with other days'.

    Frames are shuffled by source and day, so a day is sketched where its frames
    are; one of very many episodes comes out in several parts, to be merged like days.
    """
    return frame_sketches(frames, manifest, True, k, fan_in)


def percentiles_of_days(days: DataFrame, shares: list[float] | None = None, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Percentiles over any union of day_sketches() tables, the unknown day (null) included.

    Each task first merges the days of its own rows; only those sketches are shuffled.
    """
    types = [pa.string(), pa.string(), pa.int64()]

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[tuple, Sketch] = {}
        size = 0
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in FRAME_KEYS), strict=True)
            numbers = zip(*(batch[c].to_pylist() for c in ("n", "err", "level")), strict=True)
            for key, (n, err, level), readings in zip(keys, numbers, batch["readings"], strict=True):
                sketch = held.get(key)
                if sketch is None:
                    sketch = held[key] = Sketch(k, fan_in)
                    size += sketch.bytes
                before = sketch.bytes
                sketch.take(n, err, level, np.frombuffer(readings.as_buffer(), FRAME_TYPE))
                size += sketch.bytes - before
                if size > HELD_BYTES:
                    yield from _given_out(held, FRAME_KEYS, types, part, FRAME_TYPE)
                    held, size = {}, 0
        yield from _given_out(held, FRAME_KEYS, types, part, FRAME_TYPE)

    parts = days.select(*FRAME_KEYS, "n", "err", "level", "readings")
    pooled = parts.mapInArrow(pool, f"{_columns(parts, FRAME_KEYS)}, {PARTS}")
    merged = merge_sketches(pooled, FRAME_KEYS, days.rdd.getNumPartitions(), k, fan_in, MERGE_FAN_IN, FRAME_TYPE)
    return read_quantiles(merged, FRAME_KEYS, shares or SHARES, k, fan_in, FRAME_TYPE)
