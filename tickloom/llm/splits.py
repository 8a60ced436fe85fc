"""Splits that keep related records together.

1. Records are linked by what they share (task, recording); the connected
   components of these links are the groups that must not part. Links are
   reduced to stars first, so that no set of partners is ever expanded.
2. Largest-differencing balance: the two vectors of bin weights with the
   greatest spread are combined, heaviest bins with lightest, again and again,
   until one vector of nearly equal bins is left. Parts of the data do this by
   themselves; their vectors, of fixed length, are combined the same way.
3. Whole bins go to the splits, the heaviest first to the split that lacks most.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.runtime import lookup_join, shared_dir, ship

#: Bins per vector, groups that one task balances, and vectors that one task combines.
BINS = 120
GROUPS_PER_PART = 20_000
VECTORS_AT_ONCE = 64
SPLITS = {"train": 0.8, "validation": 0.1, "test": 0.1}

_OTHER = re.compile(r"[\W_]+")


def task_key(task: str | None) -> str | None:
    """Letters and digits of a task after NFKC and case folding; equal keys are the same task."""
    return None if task is None else _OTHER.sub("", unicodedata.normalize("NFKC", task).casefold())


def _keys_of(tasks: pd.Series) -> pd.Series:
    known = {t: task_key(t) for t in tasks.unique() if t is not None}
    return tasks.map(known)


def task_keys(tasks: str) -> Column:
    return F.pandas_udf(_keys_of, "string")(F.col(tasks))


def recording_key(path: Column) -> Column:
    """The uuid in a path, without case and hyphens; null if there is none."""
    found = F.regexp_replace(F.lower(F.regexp_extract(path, r"episode_([0-9A-Fa-f-]{32,36})(?:/|$)", 1)), "-", "")
    return F.when(F.length(found) == 32, found)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) of every node of the edges.

    Alternates large-star and small-star contraction until the edges no longer
    change; a node of any degree only takes part in grouped minima and joins.
    Each round is cut by checkpoint() in the shared folder. Loops and repeated
    edges are ignored, but their nodes are kept; null ends are no edges.
    """
    shared_dir(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = small.where("a <> b").distinct().checkpoint()
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def _star(links: DataFrame, by: str) -> DataFrame:
    """Edges from each task to the smallest task that shares `by` with it: as many as there are links."""
    some = links.where(F.col(by).isNotNull()).select(by, "task").distinct()
    least = some.groupBy(by).agg(F.min("task").alias("first"))
    return some.join(least, by).where("task <> first").select(F.col("task").alias("a"), F.col("first").alias("b"))


def episode_groups(manifest: DataFrame, tasks: DataFrame) -> DataFrame:
    """episode_index, group (a key of the group) and group_index of every episode of the manifest.

    Episodes of the same task or recording are in one group, and so on. An
    episode has the task of `task` or, if that is null, of `task_index`; one
    without either is bound by its recording alone, and one without that too is
    a group of its own. group_index is the smallest task_index that `tasks`
    gives to any task of the group, null if it names none. Rows with a null
    episode_index are no episodes. Repeated rows and repeated tasks count once.
    """
    ship(manifest.sparkSession)
    named = tasks.where("task_index is not null and task is not null").select("task_index", task_keys("task").alias("key")).distinct()
    by_index = named.groupBy("task_index").agg(F.min("key").alias("index_key"))
    rows = manifest.where("episode_index is not null").select(
        "episode_index", "task_index", task_keys("task").alias("key"), recording_key(F.col("rel_path")).alias("recording")
    )
    rows = lookup_join(rows, by_index, "task_index", "left")
    own = F.coalesce(F.concat(F.lit("recording:"), "recording"), F.concat(F.lit("episode:"), F.col("episode_index").cast("string")))
    links = rows.select(
        "episode_index", "recording", F.coalesce(F.concat(F.lit("task:"), F.coalesce("key", "index_key")), own).alias("task")
    ).distinct()
    links = links.checkpoint()
    edges = _star(links, "recording").unionByName(_star(links, "episode_index"))
    roots = connected_components(edges).select(F.col("node").alias("task"), "component")
    group = F.coalesce("component", "task").alias("group")
    first = named.select("task_index", F.concat(F.lit("task:"), "key").alias("task")).join(roots, "task", "left").select("task_index", group)
    first = first.groupBy("group").agg(F.min("task_index").alias("group_index"))
    episodes = links.join(roots, "task", "left").select("episode_index", group).distinct()
    return lookup_join(episodes, first, "group", "left").select("episode_index", "group", "group_index")


class _Bins:
    """Vectors of k bins and their largest-differencing combination. A bin is a tree of items."""

    def __init__(self, k: int):
        self.k = k
        self.left: list[int] = []
        self.right: list[int] = []

    def leaf(self) -> int:
        self.left.append(-1)
        self.right.append(-1)
        return len(self.left) - 1

    def both(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        self.left.append(a)
        self.right.append(b)
        return len(self.left) - 1

    def combine(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """One vector of all: always the two of the greatest spread, the heaviest bin with the lightest.

        A vector holds the weights and members of its filled bins, heaviest
        first; the others are empty, so a single item takes a single place.
        """
        heap = [(self._spread(w), i) for i, (w, _) in enumerate(vectors)]
        heapq.heapify(heap)
        held = dict(enumerate(vectors))
        fresh = len(vectors)
        while len(heap) > 1:
            (w1, m1), (w2, m2) = held.pop(heapq.heappop(heap)[1]), held.pop(heapq.heappop(heap)[1])
            both = max(0, len(w1) + len(w2) - self.k)  # so many bins are filled in either
            weight, members = np.concatenate([w1, w2[: len(w2) - both]]), np.concatenate([m1, m2[: len(w2) - both]])
            # the lightest of one go with the heaviest of the other
            at = np.arange(len(w1) - both, len(w1))
            weight[at] += w2[len(w2) - both :][::-1]
            for i, other in zip(at.tolist(), m2[len(w2) - both :][::-1].tolist(), strict=True):
                members[i] = self.both(int(members[i]), other)
            order = np.argsort(-weight, kind="stable")
            weight, members = weight[order], members[order]
            held[fresh] = (weight, members)
            heapq.heappush(heap, (self._spread(weight), fresh))
            fresh += 1
        return held[heap[0][1]]

    def _spread(self, weight: np.ndarray) -> float:
        """Minus the difference between the heaviest and the lightest bin."""
        return float((weight[-1] if len(weight) == self.k else 0.0) - weight[0])

    def items(self, node: int) -> Iterator[int]:
        stack = [node] if node >= 0 else []
        while stack:
            x = stack.pop()
            if self.left[x] < 0:
                yield x
            else:
                stack += (self.left[x], self.right[x])


def balance(weights: np.ndarray, k: int) -> np.ndarray:
    """The bin, of k, of each item; bins as equal as the largest-differencing method makes them."""
    bins = _Bins(k)
    vectors = [(np.array([w], np.float64), np.array([bins.leaf()])) for w in weights.tolist()]
    out = np.zeros(len(weights), np.int64)
    if vectors:
        _, members = bins.combine(vectors)
        for i, node in enumerate(members.tolist()):
            for item in bins.items(node):
                out[item] = i
    return out


def allocate(weights: np.ndarray, splits: dict[str, float]) -> list[str]:
    """A split for each bin: the heaviest bins first, each to the split that is furthest below its target."""
    names = list(splits)
    target = np.array([splits[s] for s in names]) / sum(splits.values()) * weights.sum()
    given = np.zeros(len(names))
    out = [""] * len(weights)
    for i in np.argsort(-weights, kind="stable"):
        at = int(np.argmax(target - given))
        given[at] += weights[i]
        out[i] = names[at]
    return out


def split_groups(groups: DataFrame, splits: dict[str, float] | None = None, bins: int = BINS, parts: int | None = None) -> DataFrame:
    """group -> split, for a table of distinct (group, weight) rows, in the proportions of splits by weight.

    A group heavier than its share leaves the proportions as near as whole
    groups allow. Groups are balanced in parts of about GROUPS_PER_PART, each in
    one task, unless parts says how many; the parts' vectors are combined in
    rounds of VECTORS_AT_ONCE. Null or negative weights count as 0.
    """
    ship(groups.sparkSession)
    splits = splits or SPLITS
    if not splits or min(splits.values()) <= 0:
        raise ValueError("every split needs a positive share")
    weighed = groups.select("group", F.greatest(F.lit(0.0), F.coalesce(F.col("weight").cast("double"), F.lit(0.0))).alias("weight"))
    left = parts or max(1, -(-weighed.count() // GROUPS_PER_PART))
    spread = weighed.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(left)))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "group"], ascending=[False, True])
        return pdf.assign(bin=balance(pdf.weight.to_numpy(), bins))

    placed = spread.groupBy("part").applyInPandas(local, "group string, weight double, part bigint, bin bigint").checkpoint()
    # where: the bin of a larger part that each bin of the first parts is in by now
    sums = placed.groupBy("part", "bin").agg(F.sum("weight").alias("weight"))
    where = sums.select("part", "bin", F.col("part").alias("in_part"), F.col("bin").alias("in_bin"), "weight")

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        trees = _Bins(bins)
        vectors, leaves = [], {}
        for part, rows in sorted(pdf.groupby("in_part")):
            rows = rows.sort_values(["weight", "in_bin"], ascending=[False, True])
            members = np.array([trees.leaf() for _ in range(len(rows))])
            leaves.update(zip(members.tolist(), ((part, b) for b in rows["in_bin"].tolist()), strict=True))
            vectors.append((rows["weight"].to_numpy(np.float64), members))
        _, members = trees.combine(vectors)
        out = [(*leaves[x], int(pdf.to_part.iloc[0]), i) for i, node in enumerate(members.tolist()) for x in trees.items(node)]
        return pd.DataFrame(out, columns=["in_part", "in_bin", "to_part", "to_bin"])

    while True:
        left = -(-left // VECTORS_AT_ONCE)
        now = where.groupBy("in_part", "in_bin").agg(F.sum("weight").alias("weight")).withColumn("to_part", F.pmod("in_part", F.lit(left)))
        moved = now.groupBy("to_part").applyInPandas(combine, "in_part bigint, in_bin bigint, to_part bigint, to_bin bigint")  # at most VECTORS_AT_ONCE * bins rows a group
        where = where.join(moved, ["in_part", "in_bin"]).select("part", "bin", F.col("to_part").alias("in_part"), F.col("to_bin").alias("in_bin"), "weight").checkpoint()
        if left == 1:
            break

    def give(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(split=allocate(pdf.weight.to_numpy(), splits))

    whole = where.groupBy("in_bin").agg(F.sum("weight").alias("weight")).orderBy("in_bin")  # at most `bins` rows
    given = whole.groupBy(F.lit(0).alias("_")).applyInPandas(give, "in_bin bigint, weight double, split string").select("in_bin", "split")
    plan = where.join(F.broadcast(given), "in_bin").select("part", "bin", F.col("in_bin").alias("whole_bin"), "split")
    return lookup_join(placed, plan, ["part", "bin"], size_of=where).select("group", "weight", "whole_bin", "split")


def split_episodes(manifest: DataFrame, tasks: DataFrame, splits: dict[str, float] | None = None) -> DataFrame:
    """episode_index, group_index, split: train, validation and test by number of episodes, groups kept whole."""
    episodes = episode_groups(manifest, tasks).checkpoint()
    sizes = episodes.groupBy("group").agg(F.count("*").alias("weight"))
    where = split_groups(sizes, splits).select("group", "split")
    return episodes.join(where, "group").select("episode_index", "group_index", "split")
