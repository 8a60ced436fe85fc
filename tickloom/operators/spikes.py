"""Implausible readings: Hampel filter, stuck runs and physical bounds, per source.

Two passes share one shuffle of the frames (see frames.frame_blocks):

1. profile: per dataset_source, feature and component, histograms of the
   values, of the steps from frame to frame and of the distances from the
   rolling median. They give the source's normal behaviour: bounds, typical
   step, median absolute deviation (MAD) and share of unchanged readings.
2. flag: a reading is a case if |x - rolling median| > k * 1.4826 * MAD of its
   source (Hampel filter), if it is out of bounds or if it belongs to a run of
   equal readings that is too long.

k follows from the source, too: it is where so few of its normal readings would
lie beyond as Rules.spike_odds says, see normal_behaviour(). Only where a window
cannot tell which of its readings are true, because it lies to one side of a
reading at the ends of an episode or because a burst fills half of it, the
neighbouring true readings settle it, see spikes_in().
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.frames import FEATURES, HALO, frame_blocks, unpack

#: Histogram bins are 2**(1/8) wide; bin 0 holds zero.
PER_OCTAVE = 8
REACH = 48 * PER_OCTAVE
KINDS = ("step", "residual", "positive", "negative")


@dataclass(frozen=True)
class Rules:
    """Parameters of the filter.

    half_window: frames on each side in the rolling median.
    hampel: the least k, in units of 1.4826 * MAD.
    spike_odds: k is so large that a normal reading lies beyond with less than these odds.
    anchor: so many readings in a row without a jump count as true motion.
    bound_spread: bounds lie so many interquantile ranges outside the 1 % and 99 % quantiles.
    stuck_odds: a run is stuck if it would arise by chance with less than these odds.
    stuck_least: and repeats at least so many readings.
    rest_spread: the same as bound_spread for components that rest.
    rest_share: a component that stands still for more than this share of frames is one that rests (a gripper).
    """

    half_window: int = 7
    hampel: float = 6.0
    spike_odds: float = 1e-12
    anchor: int = 7
    bound_spread: float = 2.0
    rest_spread: float = 0.25
    stuck_odds: float = 1e-10
    stuck_least: int = 8
    rest_share: float = 0.5

    def stuck_run(self, still: float) -> int:
        """Repeats that a component which stands still for this share of frames makes with less than stuck_odds."""
        return max(self.stuck_least, math.ceil(math.log(self.stuck_odds) / math.log(min(max(still, 1e-9), 0.999))))

    @property
    def halo(self) -> int:
        """Frames beyond a block that its readings may depend on: the longest run that any component can need, as those that stand still for more rest."""
        return max(HALO, self.stuck_run(self.rest_share) + 2 * self.half_window)


def _bin(x: np.ndarray) -> np.ndarray:
    """Histogram bin of non-negative numbers, 0 for zero."""
    with np.errstate(divide="ignore"):
        at = np.floor(np.log2(x, dtype=np.float64) * PER_OCTAVE)
    return np.where(x > 0, np.clip(at, -REACH, REACH) + REACH + 1, 0).astype(np.int64)


def _middle(at: float) -> float:
    """A number in the middle of a bin."""
    return 0.0 if at == 0 else 2.0 ** ((at - REACH - 1 + 0.5) / PER_OCTAVE)


def rolling_median(x: np.ndarray, starts: np.ndarray, half: int) -> np.ndarray:
    """Median of the 2 * half + 1 rows around each row, column by column, within the parts that begin at starts.

    At both ends of a part the nearest whole window holds; a part shorter than
    a window has one median. Missing readings repeat the reading before them.
    """
    n, width = len(x), 2 * half + 1
    out = np.empty_like(x)
    ends = np.append(starts[1:], n)
    if n >= width:
        # windows of an odd number of rows; the ones across a border are never looked up
        medians = np.empty((n - width + 1, x.shape[1]), x.dtype)
        views = np.lib.stride_tricks.sliding_window_view(x, width, axis=0)
        for i in range(0, len(medians), 8192):
            medians[i : i + 8192] = np.partition(views[i : i + 8192], half, axis=-1)[..., half]
        at = np.arange(n)
        lengths = ends - starts
        first, last = np.repeat(starts + half, lengths), np.repeat(ends - half - 1, lengths)
        out = medians[np.clip(np.clip(at, first, np.maximum(first, last)) - half, 0, len(medians) - 1)]
    for i in np.flatnonzero(ends - starts < width):
        out[starts[i] : ends[i]] = np.median(x[starts[i] : ends[i]], axis=0)
    return out


def carried_median(x: np.ndarray, starts: np.ndarray, half: int) -> np.ndarray:
    """rolling_median(), carried on by the median step of the window to readings that are not in its middle."""
    out = rolling_median(x, starts, half).astype(np.float64)
    width = 2 * half + 1
    ends = np.append(starts[1:], len(x))
    whole = ends - starts >= width
    for begins, side in ((starts[whole], -1), (ends[whole] - width, 1)):
        if len(begins):
            step = np.median(np.diff(x[begins[:, None] + np.arange(width)], axis=1), axis=1)
            for far in range(1, half + 1):
                out[begins + half + side * far] += side * far * step
    for i in np.flatnonzero(~whole & (ends - starts > 1)):
        part = x[starts[i] : ends[i]]
        out[starts[i] : ends[i]] += (np.arange(len(part)) - (len(part) - 1) / 2)[:, None] * np.median(np.diff(part, axis=0), axis=0)
    return out


def _filled(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """x with each missing reading replaced by the one before it in its part, at the head by the next, else 0."""
    missing = ~np.isfinite(x)
    if not missing.any():
        return x
    x = x.copy()
    part = np.zeros(len(x), np.int64)
    part[starts[1:]] = 1
    part = np.cumsum(part)
    for k in np.flatnonzero(missing.any(axis=0)):
        good = np.flatnonzero(~missing[:, k])
        if not len(good):
            x[:, k] = 0
            continue
        bad = np.flatnonzero(missing[:, k])
        at = np.searchsorted(good, bad)
        before, after = good[np.maximum(at - 1, 0)], good[np.minimum(at, len(good) - 1)]
        use = np.where((at > 0) & (part[before] == part[bad]), before, after)
        x[bad, k] = np.where(part[use] == part[bad], x[use, k], 0)
    return x


def _stacks(batch: pa.RecordBatch) -> Iterator[tuple[str, str, list, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of one source and width stacked: source, feature, blocks, starts, frame numbers, readings."""
    groups: dict[tuple[str, str, int], list] = {}
    for source, _, episode, lo, frame, parts in unpack(batch):
        for feature, x in parts.items():
            if x.shape[1] and len(frame):
                groups.setdefault((source, feature, x.shape[1]), []).append((episode, lo, frame, x))
    for (source, feature, _), blocks in groups.items():
        starts = np.cumsum([0, *(len(b[2]) for b in blocks[:-1])])
        yield source, feature, blocks, starts, np.concatenate([b[2] for b in blocks]), np.concatenate([b[3] for b in blocks])


def _profile(batches: Iterator[pa.RecordBatch], rules: Rules, block: int) -> Iterator[pa.RecordBatch]:
    size = 2 * REACH + 2
    totals: dict[tuple[str, str, int, str], np.ndarray] = {}
    for batch in batches:
        for source, feature, blocks, starts, frame, x in _stacks(batch):
            own = np.concatenate([(b[2] >= b[1]) & (b[2] < b[1] + block) for b in blocks])
            finite = np.isfinite(x)
            full = _filled(np.where(finite, x, np.nan).astype(np.float64), starts)
            residual = np.abs(full - carried_median(full, starts, rules.half_window))
            step = np.abs(np.diff(full, axis=0))
            next_to = np.ones(len(x), bool)
            next_to[starts] = False
            next_to[1:] &= frame[1:] == frame[:-1] + 1
            pair = (next_to[1:] & own[1:])[:, None] & finite[1:] & finite[:-1]
            reading = finite & own[:, None]
            for k in range(x.shape[1]):
                r = reading[:, k]
                value = full[r, k]
                for kind, numbers in (
                    ("step", step[pair[:, k], k]), ("residual", residual[r, k]), ("positive", value[value >= 0]), ("negative", -value[value < 0])
                ):
                    counts = np.bincount(_bin(numbers), minlength=size)
                    key = (source, feature, k, kind)
                    totals[key] = totals[key] + counts if key in totals else counts
    rows = [(s, f, k, kind, i, int(c[i])) for (s, f, k, kind), c in totals.items() for i in np.flatnonzero(c).tolist()]
    names = ("dataset_source", "feature", "component", "kind", "bin", "n")
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names))


def _quantile(bins: np.ndarray, counts: np.ndarray, q: float) -> float:
    if not counts.sum():
        return 0.0
    at = np.searchsorted(np.cumsum(counts), q * counts.sum(), side="left")
    return float(bins[min(at, len(bins) - 1)])


def normal_behaviour(histogram: dict[str, dict[int, int]], rules: Rules) -> dict[str, float]:
    """What counts as normal for one component, from its histograms.

    hampel is k * 1.4826 * MAD. The distances from the rolling median fall off
    at least exponentially; their 90 % and 99 % quantiles, which no spikes reach,
    give the rate, and the limit is where the odds of a normal reading beyond it
    fall to spike_odds. It is never under rules.hampel * 1.4826 * MAD. In steady
    motion a reading is its own rolling median and the MAD is 0; then the typical
    step is the scale.
    """
    sides = [(-_middle(b), n) for b, n in sorted(histogram.get("negative", {}).items(), reverse=True)]
    sides += [(_middle(b), n) for b, n in sorted(histogram.get("positive", {}).items())]
    values, counts = np.array([v for v, _ in sides] or [0.0]), np.array([n for _, n in sides] or [0])
    low, high = _quantile(values, counts, 0.01), _quantile(values, counts, 0.99)
    steps = sorted(histogram.get("step", {}).items())
    step_bins, step_counts = np.array([b for b, _ in steps] or [0]), np.array([n for _, n in steps] or [0])
    still = float(histogram.get("step", {}).get(0, 0)) / max(1, int(step_counts.sum()))
    # mean of the steps that are any, up to their 95 % quantile: as robust as the median, and finer where readings are whole numbers
    moved = np.where(step_bins > 0, step_counts, 0)
    usual = (step_bins > 0) & (step_bins <= _quantile(step_bins, moved, 0.95))
    sizes = np.array([_middle(b) for b in step_bins])
    typical = float((sizes * moved)[usual].sum() / max(1, moved[usual].sum()))
    residuals = sorted(histogram.get("residual", {}).items())
    far, often = np.array([b for b, _ in residuals] or [0]), np.array([n for _, n in residuals] or [0])
    mad, q90, q99 = (_middle(_quantile(far, often, q)) for q in (0.5, 0.9, 0.99))
    tail = q99 + (q99 - q90) / math.log(0.1 / 0.01) * math.log(0.01 / rules.spike_odds)
    rests = still > rules.rest_share
    spread = (rules.rest_spread if rests else rules.bound_spread) * max(high - low, np.finfo(np.float32).tiny)
    return {"low": low - spread, "high": high + spread, "hampel": max(tail, rules.hampel * 1.4826 * max(mad, typical)), "stuck": 0.0 if rests else float(rules.stuck_run(still)), "rests": float(rests)}


THRESHOLDS = ("low", "high", "hampel", "stuck", "rests")
#: Bounds that are known: (dataset_source, feature, component) -> (low, high).
Bounds = dict[tuple[str, str, int], tuple[float, float]]


def source_profiles(blocks: DataFrame, rules: Rules, block: int, bounds: Bounds | None = None) -> DataFrame:
    """One row per source: thresholds of all its components, packed. Few rows, whatever the size of the frames."""
    known = bounds or {}

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _profile(batches, rules, block)

    histograms = (
        blocks.mapInArrow(profile, "dataset_source string, feature string, component bigint, kind string, bin int, n bigint")
        .groupBy("dataset_source", "feature", "component", "kind", "bin")
        .agg(F.sum("n").alias("n"))
    )

    def thresholds(pdf):
        import pandas as pd

        packed = {}
        for feature in FEATURES:
            of = pdf[pdf.feature == feature]
            rows = []
            for k in range(int(of.component.max()) + 1 if len(of) else 0):
                mine = of[of.component == k]
                normal = normal_behaviour({kind: dict(zip(g["bin"], g["n"], strict=True)) for kind, g in mine.groupby("kind")}, rules)
                normal["low"], normal["high"] = known.get((pdf.dataset_source.iloc[0], feature, k), (normal["low"], normal["high"]))
                rows.append([normal[t] for t in THRESHOLDS])
            packed[feature] = np.array(rows, np.float64).tobytes()
        return pd.DataFrame({"profile_source": [pdf.dataset_source.iloc[0]], "state_profile": [packed[FEATURES[0]]], "action_profile": [packed[FEATURES[1]]]})

    # at most bins * kinds * components rows a source, so the group is bounded
    return histograms.groupBy("dataset_source").applyInPandas(thresholds, "profile_source string, state_profile binary, action_profile binary")


def hampel_cases(y: np.ndarray, t: np.ndarray, limit: float, rules: Rules) -> np.ndarray:
    """Which readings lie off the rolling median by more than limit.

    A window that lies to one side of a reading, or of which a burst fills half,
    may have the wrong median: there the neighbouring true readings settle it.
    """
    half, n = rules.half_window, len(y)
    off = np.abs(y - carried_median(y[:, None], np.zeros(1, np.int64), half)[:, 0]) > limit
    if not off.any():
        return off
    near = spikes_in(y, t, limit, rules.anchor)
    around = lambda x: np.convolve(x, np.ones(2 * half + 1))[half : half + n]
    at = np.arange(n)
    edge = np.minimum(at, n - 1 - at) < half
    crowded = around(off | near) >= half
    return np.where(crowded, near & (around(off) > 0), off & (near | ~edge))


def spikes_in(y: np.ndarray, t: np.ndarray, jump: float, anchor: int) -> np.ndarray:
    """Which readings lie off the neighbouring true readings by more than jump.

    Readings reached from one another in steps under jump form a stretch;
    stretches of at least anchor readings (else the longest) are true. Any
    other reading is compared with the true ones next to it: with the line
    between them and with both motions carried on. Where the nearest true reading
    is more than anchor frames away, jump grows with that distance.
    """
    out = np.zeros(len(y), bool)
    if len(y) < 3:
        return out
    cut = np.abs(np.diff(y)) > jump * np.diff(t)
    if not cut.any():
        return out
    stretch = np.concatenate([[0], np.cumsum(cut)])
    sizes = np.bincount(stretch)
    true = sizes[stretch] >= min(anchor, sizes.max())
    at, good = np.flatnonzero(~true), np.flatnonzero(true)
    if not len(at):
        return out
    right = np.searchsorted(good, at)
    has_left, has_right = right > 0, right < len(good)
    i, j = good[np.maximum(right - 1, 0)], good[np.minimum(right, len(good) - 1)]
    line = np.interp(t[at], t[good], y[good])
    off = np.abs(y[at] - line)
    for has, near, step in ((has_left, i, -1), (has_right, j, 1)):
        other = np.clip(near + step, 0, len(y) - 1)
        same = has & (stretch[other] == stretch[near]) & (other != near)
        speed = np.where(same, (y[near] - y[other]) / np.where(same, t[near] - t[other], 1), 0)
        carried = np.abs(y[at] - (y[near] + speed * (t[at] - t[near])))
        off = np.where(same, np.minimum(off, carried), off)
    # far from any true reading, beyond a stuck run or a gap, the motion may have gone on
    away = np.minimum(np.where(has_left, t[at] - t[i], np.inf), np.where(has_right, t[j] - t[at], np.inf))
    out[at] = off > jump * np.maximum(1, away / anchor)
    return out


def implausible(x: np.ndarray, t: np.ndarray, limits: dict[str, float], rules: Rules) -> np.ndarray:
    """The cases in one series: x readings in the order of the frame numbers t. NaN is missing and never a case."""
    flags = np.zeros(len(x), bool)
    present = ~np.isnan(x)
    outside = present & ~((x >= limits["low"]) & (x <= limits["high"]))
    flags |= outside
    if limits["rests"]:
        return flags
    at = np.flatnonzero(present & ~outside)
    if len(at) < 2:
        return flags
    y = x[at].astype(np.float64)
    # same[i] tells whether reading i repeats the one before it; a run of them is begin..end - 1
    same = np.concatenate([[0, 0], (y[1:] == y[:-1]).astype(np.int8), [0]])
    begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
    stuck = np.zeros(len(y), bool)
    for a, b in zip(begin, end, strict=True):
        if b - a >= limits["stuck"]:
            stuck[a:b] = True
    flags[at[stuck]] = True
    at, y = at[~stuck], y[~stuck]
    if len(at):
        flags[at[hampel_cases(y, t[at], limits["hampel"], rules)]] = True
    return flags


def _longest_repeat(x: np.ndarray, starts: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Per part and column, whether a reading repeats at least least times in a row."""
    same = np.zeros(x.shape, np.int32)
    same[1:] = x[1:] == x[:-1]
    same[starts] = 0
    total = np.cumsum(same, axis=0)
    since = np.maximum.accumulate(np.where(same == 0, total, 0), axis=0)
    return np.maximum.reduceat(total - since, starts, axis=0) >= least


def _flag(batches: Iterator[pa.RecordBatch], rules: Rules, block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        profiles = {}
        for source, state, action in zip(*(batch[c].to_pylist() for c in ("dataset_source", "state_profile", "action_profile")), strict=True):
            if source not in profiles:
                profiles[source] = {f: np.frombuffer(p, np.float64).reshape(-1, len(THRESHOLDS)) for f, p in zip(FEATURES, (state, action), strict=True)}
        episodes, frames, features, components = [], [], [], []
        for source, feature, blocks, starts, _, x in _stacks(batch):
            limits = profiles[source][feature][: x.shape[1]]
            low, high, hampel, stuck, rests = limits.T
            full = _filled(x.astype(np.float64), starts)
            # at half the limit, since what is missing, stuck or out of bounds is still in these windows; series without any are done
            unusual = np.abs(full - carried_median(full, starts, rules.half_window)) > hampel / 2
            outside = ~np.isnan(x) & ~((x >= low) & (x <= high))
            suspect = np.logical_or.reduceat(outside | (unusual & (rests == 0)), starts, axis=0)
            suspect |= _longest_repeat(full, starts, stuck) & (rests == 0)
            for i, k in zip(*np.nonzero(suspect), strict=True):
                episode, lo, t, y = blocks[i]
                cases = implausible(y[:, k], t, dict(zip(THRESHOLDS, limits[k], strict=True)), rules)
                cases &= (t >= lo) & (t < lo + block)
                if cases.any():
                    n = int(cases.sum())
                    episodes.append(np.full(n, episode))
                    frames.append(t[cases])
                    components.append(np.full(n, k))
                    features += [feature] * n
        if episodes:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(episodes), pa.int64()), pa.array(np.concatenate(frames), pa.int64()), pa.array(features, pa.string()), pa.array(np.concatenate(components), pa.int64())],
                names=["episode_index", "frame_index", "feature", "component"],
            )


def implausible_readings(frames: DataFrame, manifest: DataFrame, rules: Rules | None = None, block: int = 4096, bounds: Bounds | None = None) -> DataFrame:
    """Every component of every frame that holds a reading the robot cannot have produced.

    Columns: episode_index, frame_index, feature ('observation.state' or
    'action'), component (zero-based). A case lies off the rolling median by more
    than k MADs of its source, or outside the bounds of its source (those in
    bounds, else from its quantiles), or repeats the reading before it for far
    longer than the source otherwise does. Null vectors and NaN are missing
    readings; components that rest (grippers) are tested for bounds only.
    Infinite readings are outside the bounds. Repeated frames count once; an
    empty table gives no rows.
    """
    rules = rules or Rules()
    blocks = frame_blocks(frames, manifest, block, rules.halo)
    profiles = source_profiles(blocks, rules, block, bounds)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _flag(batches, rules, block)

    # one packed row a source: bounded by the number of sources, not by the frames
    joined = blocks.join(F.broadcast(profiles), F.col("dataset_source") == F.col("profile_source"))
    return joined.mapInArrow(flag, "episode_index bigint, frame_index bigint, feature string, component bigint")
