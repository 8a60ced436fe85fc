"""Long exact spans shared between records, by fixed-block anchors.

A span of at least `span` code points that stands in two texts holds, in either,
a whole block of span // 2 code points that begins at a multiple of that length.
So the non-overlapping blocks of all texts are the index, every rolling window
is probed, and hits are extended. What decides whether this stays linear is how
windows and blocks meet. Here neither is sent around one by one:

1. Meeting points. Of every span // 2 + 1 windows in a row, which is one stretch
   of `span` code points, the one of least hash is a seed. The choice depends on
   the stretch alone, so two texts that share a stretch have a seed in common
   there. Seeds are about one window in 26; those of one document alone are gone
   after one grouped minimum and maximum.
2. Anchors. What surrounds a common seed, at most 2 * span code points, goes to the
   task of that seed. There the blocks of all texts around it are indexed and
   every rolling window is probed.
3. Extension. The stretches of `span` code points around a hit are compared, and
   the ones that two documents have are joined into maximal repeats.

A seed that very many texts have (a passage in a third of all documents) never
comes together in one task: its stretches are compared by grouped minimum and
maximum instead, which Spark combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.runtime import fits_broadcast, lookup_join, materialize, ship

SPAN = 100
#: Code points hashed at a time; a longer text is hashed stretch by stretch.
STRETCH = 1 << 17
#: Surroundings of a seed that are compared in one task (about 200 MB of a worker), and rows compared at a time if seeds have fewer.
TOGETHER = 1 << 15
AT_ONCE = 1 << 13
#: Code points of a text in whose bounds intervals are joined.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_NONE = np.uint64(2**64 - 1)
#: Low bits of a seed's rank that come from its place, so that equal windows of a repeating text are not all seeds.
_PLACE_BITS = np.uint64(8)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mixed(points: np.ndarray) -> np.ndarray:
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of size code points along the last axis, by doubling: log2(size) passes."""
    total = points.shape[-1]
    if total < size:
        return np.empty((*points.shape[:-1], 0), np.uint64)
    now, length = _mixed(points), 1
    out, done = None, 0
    rest = size
    while True:
        if rest & 1:
            if out is None:
                out, done = now, length
            else:
                n = total - done - length + 1
                out = out[..., :n] * np.uint64(pow(_BASE, length, 1 << 64)) + now[..., done : done + n]
                done += length
        rest >>= 1
        if not rest:
            break
        n = total - 2 * length + 1
        now = now[..., :n] * np.uint64(pow(_BASE, length, 1 << 64)) + now[..., length : length + n]
        length *= 2
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0x9FB21C651E98DF25)
    return out ^ (out >> np.uint64(28))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best (minimum or maximum) of x[i : i + width] for each i, by doubling."""
    now, length = x, 1
    while length * 2 <= width:
        now = best(now[: len(now) - length], now[length:])
        length *= 2
    return now if length == width else best(now[: len(x) - width + 1], now[width - length : width - length + len(x) - width + 1])


def stretches_of(length: int, span: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of the parts of a long text that are hashed at a time: each span lies in just one."""
    step = max(span, STRETCH // span * span)
    for at in range(0, max(1, length - span + 1), step):
        yield at, min(length, at + step + span - 1)


def _bunches(texts: list[str], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of texts put one after the other, about STRETCH code points at a time.

    Gives the code points, and of each part its first place among them, its text and where in the text it begins.
    """
    held, places, owners, begins, size = [], [], [], [], 0
    for i, text in enumerate(texts):
        for begin, end in stretches_of(len(text), span):
            part = text if end - begin == len(text) else text[begin:end]
            if size and size + len(part) > STRETCH:
                yield code_points("".join(held)), np.array(places), np.array(owners), np.array(begins)
                held, places, owners, begins, size = [], [], [], [], 0
            held.append(part)
            places.append(size)
            owners.append(i)
            begins.append(begin)
            size += len(part)
    if size:
        yield code_points("".join(held)), np.array(places), np.array(owners), np.array(begins)


def seeds_of(texts: list[str], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, text, place) of the seeds of many texts: in each `span` code points the window of least hash.

    Of equal windows one is taken by its place; which of them makes no difference, since seeds meet by hash.
    """
    size = span // 2
    width = span - size + 1
    for points, places, owners, begins in _bunches(texts, span):
        if len(points) < span:
            continue
        lengths = np.diff(np.append(places, len(points)))
        n = len(points) - size + 1
        rank = window_hashes(points, size)
        inside = np.arange(len(points)) - np.repeat(places, lengths)
        left = np.repeat(lengths, lengths) - inside
        place = inside + np.repeat(begins, lengths)
        rank = (rank >> _PLACE_BITS << _PLACE_BITS) | (place[:n].astype(np.uint64) * np.uint64(_BASE) >> np.uint64(64) - _PLACE_BITS)
        rank[left[:n] < size] = _NONE  # windows across two texts
        least = _sliding(rank, width, np.minimum)
        least[left[: len(least)] < span] = 0
        # a window is a seed if it is the least of any stretch that it lies in
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        most = _sliding(padded, width, np.maximum)[:n]
        at = np.flatnonzero((most == rank) & (rank != _NONE) & (most > 0))
        text = np.repeat(owners, lengths)[at]
        yield (rank[at] >> _PLACE_BITS).view(np.int64), text, place[at]


def _types(docs: DataFrame, doc_id: str) -> tuple[str, pa.DataType]:
    kind = docs.schema[doc_id].dataType
    return kind.simpleString(), to_arrow_type(kind)


def distinct_texts(docs: DataFrame, span: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(lo, hi, tid, text), a row per text of at least span code points, and (doc_id, shared_chars) of those that stand under two ids.

    lo and hi are the least and greatest id of a text. Texts are told apart by a
    256-bit digest; lo and tid, 64 bits of it, name a text. Only digests are
    grouped; texts are joined to the copied digests, which are few.
    """
    rows = docs.where(F.col(doc_id).isNotNull() & (F.char_length(text) >= span)).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    copies = materialize(groups.where("lo <> hi"), "span-copies")
    texts = lookup_join(rows, copies, "digest", "left").where("lo is null or doc_id = lo")
    texts = texts.select(F.col("doc_id").alias("lo"), F.coalesce("hi", "doc_id").alias("hi"), F.xxhash64("digest").alias("tid"), "text")
    if not fits_broadcast(copies):
        texts = materialize(texts, "span-texts")  # else every pass would move the texts
    copied = lookup_join(rows.select("doc_id", "digest", F.char_length("text").cast("bigint").alias("shared_chars")), copies.select("digest"), "digest")
    return texts, copied.select("doc_id", "shared_chars")


def _seeds(texts: DataFrame, span: int, with_places: bool) -> DataFrame:
    """hash, lo and hi of every seed; with places also the text and the place."""
    kind, arrow = _types(texts, "lo")
    names = ["hash", "lo", "tid", "place"] if with_places else ["hash", "lo", "hi"]
    schema = f"hash bigint, lo {kind}, tid bigint, place bigint" if with_places else f"hash bigint, lo {kind}, hi {kind}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                for hashes, text, place in seeds_of(batch["text"].to_pylist(), span):
                    rows = pa.array(text)
                    ends = [batch["tid"].take(rows), pa.array(place)] if with_places else [batch["hi"].take(rows)]
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), batch["lo"].take(rows), *ends], names=names)

    return texts.mapInArrow(scan, schema)


def _packed(points: np.ndarray) -> bytes:
    """Code points in the fewest bytes each that hold them all."""
    top = int(points.max(initial=0))
    return points.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def _surroundings(texts: DataFrame, hits: DataFrame, span: int) -> DataFrame:
    """hash, lo, hi, tid, begin, n and points: the code points around each common seed, as far as a span with it reaches."""
    kind, arrow = _types(texts, "lo")
    size = span // 2
    # at most one seed a window, so the list of a text is smaller than the text
    wanted = materialize(hits.groupBy("lo", "tid").agg(F.collect_list(F.struct("hash", "place")).alias("seeds")), "span-seeds")
    joined = lookup_join(texts, wanted, ["lo", "tid"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"].to_pylist()):
                points = code_points(text)
                seeds = batch["seeds"][i].values
                hashes, places = seeds.field("hash"), seeds.field("place").to_numpy()
                for at in range(0, len(places), 1000):
                    some = slice(at, at + 1000)
                    begin = np.maximum(0, places[some] - (span - size))
                    end = np.minimum(len(points), places[some] + span)
                    n = len(begin)
                    same = pa.array(np.full(n, i))
                    yield pa.RecordBatch.from_arrays(
                        [hashes[some], *(batch[c].take(same) for c in ("lo", "hi", "tid")), pa.array(begin),
                         pa.array((end - begin).astype(np.int32)), pa.array([_packed(points[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())],
                        names=["hash", "lo", "hi", "tid", "begin", "n", "points"],
                    )

    return joined.select("lo", "hi", "tid", "text", "seeds").mapInArrow(cut, f"hash bigint, lo {kind}, hi {kind}, tid bigint, begin bigint, n int, points binary")


def _matrix(batch: pa.Table | pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The code points of each row, padded, and how many they are."""
    n = batch["n"].to_numpy()
    out = np.zeros((len(n), width), np.uint32)
    column = batch["points"].combine_chunks() if isinstance(batch, pa.Table) else batch["points"]
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(n) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    bytes_each = np.diff(offsets) // np.maximum(n, 1)
    for each, kind in ((1, np.uint8), (2, np.uint16), (4, np.uint32)):
        rows = np.flatnonzero(bytes_each == each)
        for count in np.unique(n[rows]).tolist():
            some = rows[n[rows] == count]
            at = offsets[some].astype(np.int64)[:, None] + np.arange(count * each)
            out[some, :count] = np.ascontiguousarray(data[at]).view(kind)
    return out, n


def _halves(hashes: np.ndarray, row: np.ndarray, column: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the span that begins at each place: of its first half, and of the rest."""
    size = span // 2
    rest = hashes[row, column + size]
    return hashes[row, column], rest if span % 2 == 0 else rest * np.uint64(_BASE) + hashes[row, column + span - size]


def _ranks(ids: np.ndarray | pa.Array, more: np.ndarray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document ids of two columns as whole numbers of the same order."""
    both = pa.concat_arrays([ids, more])
    order = np.unique(both.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return order[: len(ids)], order[len(ids) :]


def common_stretches(table: pa.Table, span: int) -> np.ndarray:
    """For each row (lo, hi, begin, n, points) and place in it, whether `span` code points from there stand in a text of another document, too.

    The blocks of all rows are indexed, all windows probed; of the stretches that
    hold a hit those are common that two documents have. A stretch is told by the
    hashes of both its halves, 128 bits.
    """
    size = span // 2
    width = int(table["n"].to_numpy().max(initial=span))
    points, n = _matrix(table, width)
    lo, hi = _ranks(table["lo"].combine_chunks(), table["hi"].combine_chunks())
    hashes = window_hashes(points, size)
    place = np.arange(hashes.shape[1])
    whole = place + size <= n[:, None]
    # the index: blocks at multiples of their length in their own text
    row, column = np.nonzero(whole & ((table["begin"].to_numpy()[:, None] + place) % size == 0))
    blocks, owner = np.unique(hashes[row, column], return_inverse=True)
    least, most = np.full(len(blocks), len(lo) * 2), np.full(len(blocks), -1)
    np.minimum.at(least, owner, lo[row])
    np.maximum.at(most, owner, hi[row])
    # the probe: every window
    at = np.minimum(np.searchsorted(blocks, hashes.ravel()), max(0, len(blocks) - 1)).reshape(hashes.shape)
    hit = whole & (blocks[at] == hashes) if len(blocks) else np.zeros(hashes.shape, bool)
    hit &= (least[at] != lo[:, None]) | (most[at] != hi[:, None]) if len(blocks) else False
    # the extension: a stretch with a hit in it, that two documents have
    starts = width - span + 1
    so_far = np.concatenate([np.zeros((len(n), 1), np.int32), np.cumsum(hit, axis=1, dtype=np.int32)], axis=1)
    reach = span - size + 1
    held = (so_far[:, reach : reach + starts] > so_far[:, :starts]) & (np.arange(starts) + span <= n[:, None])
    row, column = np.nonzero(held)
    one, two = _halves(hashes, row, column, span)
    order = np.lexsort((two, one))
    one, two, row, column = one[order], two[order], row[order], column[order]
    first = np.ones(len(one), bool)
    first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    out = np.zeros((len(n), starts), bool)
    if len(one):
        groups = np.flatnonzero(first)
        both = np.minimum.reduceat(lo[row], groups) != np.maximum.reduceat(hi[row], groups)
        shared = np.repeat(both, np.diff(np.append(groups, len(one))))
        out[row[shared], column[shared]] = True
    return out


def _intervals(common: np.ndarray, table: pa.Table, span: int) -> Iterator[pa.RecordBatch]:
    """lo, tid, piece, begin and end of what common stretches cover, cut where pieces end. Texts under two ids have no need of it."""
    alone = table["lo"].combine_chunks().to_numpy(zero_copy_only=False) == table["hi"].combine_chunks().to_numpy(zero_copy_only=False)
    edges = np.diff(np.pad(common & alone[:, None], ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    start = table["begin"].to_numpy()[row]
    begin, end = start + first, start + after - 1 + span
    while len(row):
        piece = begin // PIECE
        stop = np.minimum(end, (piece + 1) * PIECE)
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [table["lo"].combine_chunks().take(at), table["tid"].combine_chunks().take(at), pa.array(piece), pa.array(begin), pa.array(stop)], names=["lo", "tid", "piece", "begin", "end"]
        )
        rest = stop < end
        row, begin, end = row[rest], stop[rest], end[rest]


def _compare(few: DataFrame, span: int) -> DataFrame:
    """Intervals of the surroundings of seeds that few texts have: those of one seed are compared in one task."""
    kind, _ = _types(few, "lo")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            while kept.num_rows > AT_ONCE:
                seed = kept["hash"].to_numpy()
                borders = np.flatnonzero(seed[1:] != seed[:-1]) + 1
                if not len(borders):
                    break
                end = int(borders[max(0, np.searchsorted(borders, AT_ONCE, "right") - 1)])
                part = kept.slice(0, end).combine_chunks()
                yield from _intervals(common_stretches(part, span), part, span)
                kept = kept.slice(end)
        if kept is not None and kept.num_rows:
            kept = kept.combine_chunks()
            yield from _intervals(common_stretches(kept, span), kept, span)

    ordered = few.repartition("hash").sortWithinPartitions("hash")
    return ordered.mapInArrow(compare, f"lo {kind}, tid bigint, piece bigint, begin bigint, end bigint")


def _group(many: DataFrame, span: int) -> DataFrame:
    """Intervals of the surroundings of seeds that very many texts have: stretch by stretch, by grouped minimum and maximum."""
    kind, _ = _types(many, "lo")
    size = span // 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                width = int(batch["n"].to_numpy().max(initial=span))
                points, n = _matrix(batch, width)
                hashes = window_hashes(points, size)
                row, column = np.nonzero(np.arange(width - span + 1) + span <= n[:, None])
                one, two = _halves(hashes, row, column, span)
                same = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), *(batch[c].take(same) for c in ("lo", "hi", "tid")), pa.array(batch["begin"].to_numpy()[row] + column)],
                    names=["one", "two", "lo", "hi", "tid", "begin"],
                )

    rows = many.drop("hash").mapInArrow(spread, f"one bigint, two bigint, lo {kind}, hi {kind}, tid bigint, begin bigint")
    groups = rows.groupBy("one", "two").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).where("_lo <> _hi").select("one", "two")
    shared = rows.where("lo = hi").join(groups, ["one", "two"])
    ends = shared.select("lo", "tid", "begin", (F.col("begin") + span).alias("end"))
    piece = F.explode(F.sequence(F.expr(f"begin div {PIECE}"), F.expr(f"(end - 1) div {PIECE}")))
    cut = ends.withColumn("piece", piece)
    return cut.select("lo", "tid", "piece", F.greatest("begin", F.col("piece") * PIECE).alias("begin"), F.least("end", (F.col("piece") + 1) * PIECE).alias("end"))


def shared_spans(docs: DataFrame, span: int = SPAN, doc_id: str = "doc_id", text: str = "text", together: int = TOGETHER) -> DataFrame:
    """doc_id, shared_chars: how many code points of a text lie in a span of at least `span` that stands in the text of another id.

    Ids without any are left out, as are null ids and null or shorter texts.
    Repeated rows of one id and text are one; of several texts under one id each
    counts by itself and the id has their largest number; what only texts of one
    id have in common is not shared, nor is a span that occurs twice in one text.
    together: seeds of more texts are compared by grouping; the result is the same.
    """
    if span < 2:
        raise ValueError("span must be at least 2")
    ship(docs.sparkSession)
    texts, copied = distinct_texts(docs, span, doc_id, text)
    meeting = _seeds(texts, span, False).groupBy("hash").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), F.count("*").alias("_n"))
    common = materialize(meeting.where("_lo <> _hi").select("hash", (F.col("_n") > together).alias("many")), "span-meeting")
    hits = lookup_join(_seeds(texts, span, True), common, "hash")
    covered = _compare(_surroundings(texts, hits.where(~F.col("many")), span), span)
    if not common.where("many").isEmpty():
        # read by the grouping and by the join
        covered = covered.unionByName(_group(materialize(_surroundings(texts, hits.where("many"), span), "span-around"), span))
    covered = covered.distinct()
    before = F.max("end").over(W.partitionBy("lo", "tid", "piece").orderBy("begin", "end").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("begin"), F.coalesce(before, F.lit(0))))
    counted = covered.withColumn("fresh", fresh).groupBy("lo", "tid").agg(F.sum("fresh").cast("bigint").alias("shared_chars"))
    both = counted.select(F.col("lo").alias("doc_id"), "shared_chars").unionByName(copied)
    return both.groupBy("doc_id").agg(F.max("shared_chars").alias("shared_chars"))
