"""Matching records of two tables by nearest time.

Both tables are repartitioned by entity (and stretch of time), sorted, and
walked through once: a merge that holds only the right records next to the
current left ones. A right record within tolerance of the border of a stretch
goes to both sides, so an entity of any size spreads over many tasks and no
pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.grid import readings, recording_spans
from tickloom.runtime import ship

#: ns in one stretch of an entity.
STRETCH = 120_000_000_000


def _whole(t: Column, size: int) -> Column:
    """t // size in whole numbers; doubles would lose digits of ns."""
    return F.round((t - F.pmod(t, F.lit(size))) / F.lit(size)).cast("bigint")


def nearest(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, left_id: str, right_id: str, tolerance: int, left_out: str = "left_id", right_out: str = "right_id", stretch: int = STRETCH
) -> DataFrame:
    """For each left record the right record of the same keys nearest in time, if at most tolerance away.

    Columns: keys, left_out, right_out. time is a bigint in both tables. Of two
    equally near records the earlier holds, of several at one time the smallest
    right_id. Rows with a null key, time or id match nothing. Repeated left rows
    (same keys, time and id) count once; left records without a match are left out.
    """
    if tolerance < 0 or stretch <= 2 * tolerance:
        raise ValueError("stretch must be more than twice the tolerance, which must not be negative")
    if {left_out, right_out} & set(keys) or left_out == right_out or {"_stretch", "_t", "_side", "_l", "_r"} & set(keys):
        raise ValueError(f"the names of keys and results clash: {keys}, {left_out}, {right_out}")
    ship(left.sparkSession)
    l_type, r_type = left.schema[left_id].dataType.simpleString(), right.schema[right_id].dataType.simpleString()

    def side(df: DataFrame, own: str, number: int, stretches: Column) -> DataFrame:
        known = df.where(F.col(time).isNotNull() & F.col(own).isNotNull())
        for key in keys:
            known = known.where(F.col(key).isNotNull())
        ids = [F.col(own).alias("_l") if number else F.lit(None).cast(l_type).alias("_l"), F.lit(None).cast(r_type).alias("_r") if number else F.col(own).alias("_r")]
        return known.select(*keys, F.explode(stretches).alias("_stretch"), F.col(time).cast("bigint").alias("_t"), F.lit(number).alias("_side"), *ids)

    t = F.col(time).cast("bigint")
    lefts = side(left, left_id, 1, F.array(_whole(t, stretch)))
    rights = side(right, right_id, 0, F.sequence(_whole(t - tolerance, stretch), _whole(t + tolerance, stretch)))
    ordered = lefts.unionByName(rights).repartition(*keys, "_stretch").sortWithinPartitions(*keys, "_stretch", "_t", "_side", "_r", "_l")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merge(batches, keys, tolerance, left_out, right_out)

    named = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)
    return ordered.mapInArrow(merge, f"{named}, `{left_out}` {l_type}, `{right_out}` {r_type}")


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row differs from the one before it in any of the columns; True for the first."""
    out = np.zeros(table.num_rows, bool)
    out[:1] = True
    for name in names:
        column = table[name].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        differ = pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
        none = column.is_null().to_numpy(zero_copy_only=False)
        out[1:] |= np.where(none[1:] & none[:-1], False, differ)
    return out


def _merge(batches: Iterator[pa.RecordBatch], keys: list[str], tolerance: int, left_out: str, right_out: str) -> Iterator[pa.RecordBatch]:
    kept: pa.Table | None = None

    def step(table: pa.Table, last: bool) -> tuple[pa.Table | None, pa.Table | None]:
        """The pairs that are certain, and the rows that later ones may still need."""
        table = table.combine_chunks()
        new_group = _changes(table, [*keys, "_stretch"])
        group = np.cumsum(new_group)
        t = table["_t"].to_numpy()
        is_left = table["_side"].to_numpy() == 1
        repeat = ~_changes(table, [*keys, "_stretch", "_t", "_side", "_l", "_r"])
        # of right records at one time the first, with the smallest id, stands for all
        right = np.flatnonzero(~is_left)
        if len(right):
            again = np.concatenate([[False], (group[right][1:] == group[right][:-1]) & (t[right][1:] == t[right][:-1])])
            right = right[~again]
        lefts = np.flatnonzero(is_left & ~repeat)
        at = np.searchsorted(right, lefts)
        has_before, has_after = at > 0, at < len(right)
        before = right[np.maximum(at - 1, 0)] if len(right) else np.zeros(len(lefts), np.int64)
        after = right[np.minimum(at, len(right) - 1)] if len(right) else np.zeros(len(lefts), np.int64)
        has_before &= group[before] == group[lefts]
        has_after &= group[after] == group[lefts]
        far = np.iinfo(np.int64).max
        d0 = np.where(has_before, t[lefts] - t[before], far)
        d1 = np.where(has_after, t[after] - t[lefts], far)
        # a left record waits while a right one within tolerance may still come and be nearer
        waits = ~has_after & (group[lefts] == group[-1]) & (t[-1] - t[lefts] <= np.minimum(tolerance, d0)) & (not last)
        match = np.where(d0 <= d1, before, after)
        found = (np.minimum(d0, d1) <= tolerance) & ~waits
        pairs = None
        if found.any():
            l_rows, r_rows = table.take(pa.array(lefts[found])), table["_r"].take(pa.array(match[found]))
            pairs = pa.table([l_rows[k] for k in keys] + [l_rows["_l"], r_rows], names=[*keys, left_out, right_out])
        if last:
            return pairs, None
        # the last right record of the group, what waits, and the last row (to know a repeat of it)
        need = lefts[waits].tolist()
        mine = right[group[right] == group[-1]] if len(right) else right
        earliest = lefts[waits][0] if waits.any() else table.num_rows
        need += mine[mine > earliest].tolist() + mine[mine < earliest][-1:].tolist()
        return pairs, table.take(pa.array(sorted(set(need)), pa.int64()))

    done: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        # a repeat of a left record already given out may stand at the head of a batch
        if done is not None:
            joined = pa.concat_tables([done, table])
            same = ~_changes(joined, joined.column_names)
            run = int(np.argmin(np.append(same[1:], False)))
            table = table.slice(run)
            if not table.num_rows:
                continue
        done = table.slice(table.num_rows - 1)
        if kept is not None and kept.num_rows:
            table = pa.concat_tables([kept, table])
        pairs, kept = step(table, False)
        if pairs is not None:
            yield from pairs.to_batches()
    if kept is not None and kept.num_rows:
        pairs, _ = step(kept, True)
        if pairs is not None:
            yield from pairs.to_batches()


#: The state topic that each camera looks along.
CAMERA_TOPICS = {"top": "/left-arm-state", "left_wrist": "/left-arm-state", "right_wrist": "/right-arm-state"}
TOLERANCE_NS = 20_000_000


def camera_states(raw_camera: DataFrame, raw_messages: DataFrame, recordings: DataFrame, schemas: DataFrame, tolerance: int = TOLERANCE_NS) -> DataFrame:
    """episode_id, camera, camera_seq, state_seq: each camera row with the nearest reading of its state topic.

    Camera rows need data that is not null, messages a value that is neither
    null nor empty; both a log_time inside the recording. Other cameras than
    those of CAMERA_TOPICS have no state topic and no row.
    """
    spans = recording_spans(recordings, schemas)
    topic = F.create_map(*(F.lit(x) for pair in CAMERA_TOPICS.items() for x in pair))
    shots = readings(raw_camera.select("episode_id", "camera", "log_time", "seq", "data"), spans, "data", recordings).select(
        "episode_id", F.try_element_at(topic, F.col("camera")).alias("topic"), "log_time", F.struct("camera", "seq").alias("shot")
    )
    wanted = sorted(set(CAMERA_TOPICS.values()))
    states = readings(raw_messages.select("episode_id", "topic", "log_time", "seq", "value"), spans, size_of=recordings).where(F.col("topic").isin(wanted))
    # cameras share a topic: the id of a shot is camera and seq, packed into one sortable string
    packed = shots.where("shot.seq is not null").withColumn("shot", F.concat_ws("/", "shot.camera", "shot.seq"))
    pairs = nearest(packed, states.select("episode_id", "topic", "log_time", "seq"), ["episode_id", "topic"], "log_time", "shot", "seq", tolerance, "shot", "state_seq")
    return pairs.select(
        "episode_id", F.substring_index("shot", "/", 1).alias("camera"), F.substring_index("shot", "/", -1).cast("bigint").alias("camera_seq"), "state_seq"
    )
