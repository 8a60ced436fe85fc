"""Frames as ordered, deduplicated blocks.

An episode is cut into blocks of frames; one output row holds one block as
packed float matrices. Blocks overlap by a halo, so that windowed operators
need no other row, and an episode of any length spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.runtime import block_keys, lookup_join, ship

FEATURES = ("observation.state", "action")
BLOCK = 4096
HALO = 128
#: Episodes of one source and day that are brought to one place.
EPISODES_PER_PART = 2000

BLOCK_SCHEMA = (
    "dataset_source string, day date, episode_index bigint, lo bigint, frame binary, "
    "state binary, state_dim int, action binary, action_dim int"
)


def episode_sources(manifest: DataFrame) -> DataFrame:
    """One row per episode_index: its dataset_source and recording day (null if not known).

    Rows without episode_index or dataset_source are no entry. Repeated rows
    collapse; of contradicting ones the smallest source and earliest day hold.
    """
    return (
        manifest.where(F.col("episode_index").isNotNull() & F.col("dataset_source").isNotNull())
        .groupBy("episode_index")
        .agg(F.min("dataset_source").alias("dataset_source"), F.min(F.to_date("recorded_at")).alias("day"))
    )


def day_salts(sources: DataFrame, per_part: int = EPISODES_PER_PART) -> DataFrame:
    """Add `salt` to the episodes: a day of a source that has very many of them is spread over several parts."""
    sizes = sources.groupBy(F.col("dataset_source").alias("_source"), F.col("day").alias("_day")).agg(F.ceil(F.count("*") / F.lit(per_part)).alias("_parts"))
    sized = sources.join(sizes, (F.col("dataset_source") == F.col("_source")) & F.col("day").eqNullSafe(F.col("_day")))
    return sized.select("episode_index", "dataset_source", "day", F.pmod(F.xxhash64("episode_index"), F.col("_parts")).alias("salt"))


def frame_blocks(frames: DataFrame, manifest: DataFrame, block: int = BLOCK, halo: int = HALO, by_day: bool = False) -> DataFrame:
    """Blocks of frames with their source: one shuffle by (episode, block), sorted, repeated rows removed.

    With by_day the shuffle brings the blocks of one source and recording day
    together instead, except that a day of very many episodes or an episode of
    several blocks is spread over as many places.

    Frames without episode_index or frame_index, or of an episode that the
    manifest does not name, are left out. A null vector becomes missing (NaN). Of
    several rows for one frame the one with the greatest vectors stays.
    """
    rows = (
        frames.where(F.col("episode_index").isNotNull() & (F.col("frame_index") >= 0))
        .select(
            "episode_index",
            "frame_index",
            F.col("`observation.state`").cast("array<float>").alias("state"),
            F.col("action").cast("array<float>").alias("action"),
        )
    )
    ship(frames.sparkSession)
    sources = episode_sources(manifest)
    rows = lookup_join(rows, day_salts(sources) if by_day else sources.withColumn("salt", F.lit(0)), "episode_index", size_of=sources)
    rows = rows.withColumn("block", F.explode(block_keys(F.col("frame_index"), block, halo)))
    spread = ["dataset_source", "day", "salt", "block"] if by_day else ["episode_index", "block"]
    within = [c for c in ("episode_index", "block") if c not in spread]
    ordered = (
        rows.select("dataset_source", "day", "salt", "episode_index", "block", "frame_index", "state", "action")
        .repartition(*spread)
        .sortWithinPartitions(*spread, *within, "frame_index", F.desc_nulls_last("state"), F.desc_nulls_last("action"))
        .drop("salt")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack(batches, block)

    return ordered.mapInArrow(pack, BLOCK_SCHEMA)


def _matrix(column: pa.ListArray, lo: int, hi: int) -> np.ndarray:
    """Rows lo..hi of a list column as a float32 matrix; null or short vectors are filled with NaN."""
    part = column.slice(lo, hi - lo)
    offsets = np.asarray(part.offsets)
    widths = np.diff(offsets)
    values = np.asarray(part.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False), np.float32)
    if part.null_count:
        widths = np.where(np.asarray(part.is_null()), 0, widths)
    dim = int(widths.max(initial=0))
    if dim and (widths == dim).all() and len(values) == dim * (hi - lo):
        return values.reshape(-1, dim)
    out = np.full((hi - lo, dim), np.nan, np.float32)
    for i in np.flatnonzero(widths):
        begin = offsets[i] - offsets[0]
        out[i, : widths[i]] = values[begin : begin + widths[i]]
    return out


def _pack(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("dataset_source", pa.string()), ("day", pa.date32()), ("episode_index", pa.int64()), ("lo", pa.int64()),
            ("frame", pa.binary()), ("state", pa.binary()), ("state_dim", pa.int32()), ("action", pa.binary()), ("action_dim", pa.int32()),
        ]
    )
    kept: pa.Table | None = None

    def emit(table: pa.Table, final: bool) -> tuple[list[dict], pa.Table | None]:
        rows = table.combine_chunks()
        episode, number, frame = (rows[c].to_numpy() for c in ("episode_index", "block", "frame_index"))
        cuts = np.flatnonzero((episode[1:] != episode[:-1]) | (number[1:] != number[:-1])) + 1
        edges = [0, *cuts.tolist(), len(episode)]
        state, action = (rows[c].chunk(0) if rows[c].num_chunks else None for c in ("state", "action"))
        out = []
        for lo, hi in zip(edges[:-1], edges[1:] if final else edges[1:-1], strict=False):
            t = frame[lo:hi]
            first = np.ones(hi - lo, bool)
            first[1:] = t[1:] != t[:-1]
            s, a = _matrix(state, lo, hi), _matrix(action, lo, hi)
            if not first.all():
                t, s, a = t[first], s[first], a[first]
            out.append(
                {
                    "dataset_source": rows["dataset_source"][lo].as_py(), "day": rows["day"][lo].as_py(), "episode_index": int(episode[lo]), "lo": int(number[lo]) * block,
                    "frame": t.astype(np.int64).tobytes(), "state": s.tobytes(), "state_dim": s.shape[1], "action": a.tobytes(), "action_dim": a.shape[1],
                }
            )
        return out, None if final else table.slice(edges[-2])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        out, kept = emit(table, False)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if kept is not None and kept.num_rows:
        out, _ = emit(kept, True)
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[str, object, int, int, np.ndarray, dict[str, np.ndarray]]]:
    """The blocks of a batch: source, day, episode, first own frame, frame numbers, and a matrix per feature."""
    source, day, episode, lo = (batch[c].to_pylist() for c in ("dataset_source", "day", "episode_index", "lo"))
    state_dim, action_dim = batch["state_dim"].to_pylist(), batch["action_dim"].to_pylist()
    for i in range(batch.num_rows):
        frame = np.frombuffer(batch["frame"][i].as_buffer(), np.int64)
        parts = {}
        for feature, name, dim in (("observation.state", "state", state_dim[i]), ("action", "action", action_dim[i])):
            parts[feature] = np.frombuffer(batch[name][i].as_buffer(), np.float32).reshape(len(frame), dim)
        yield source[i], day[i], episode[i], lo[i], frame, parts
