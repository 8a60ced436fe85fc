"""Evaluation texts leaking into training text, by pigeonhole edit matching.

Every run of `passage` words of an item is a passage. With a budget of e word
edits a passage is split into e + 1 pieces; if a text holds the passage with at
most e edits, at least one piece stands in it unchanged. So pieces are looked up
exactly, with rolling hashes, and each hit is verified with Myers' bit-parallel
edit distance on words, for many hits at a time.

Texts are read once, however many items there are: the pieces of all items are a
table, and a bit filter of bounded size tells which places of a text may hold
one. Those places, each with the words around it, are joined to the pieces. A
passage that many items have in common is one row until it has been verified.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.runtime import lookup_join, materialize, ship

PASSAGE = 13
BUDGET = 1
#: Bits of the filter, at most: 16 MB for a worker. Beyond 16 bits a piece it lets more places pass, which the join then drops.
FILTER_BITS = 1 << 27
BITS_PER_PIECE = 16
#: Code points of a text that are normalised at a time.
PART = 1 << 20
#: Hits verified at a time, and words whose numbers a worker remembers.
AT_ONCE = 1 << 14
REMEMBERED = 1 << 20

WORDS = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits after NFKC and case folding."""
    return [] if not text else WORDS.findall(unicodedata.normalize("NFKC", text).casefold())


class _Numbers(dict):
    """The number of a word: 64 bits of its digest, never 0."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        number = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") or 1
        self[word] = number
        return number


def word_ids(text: str, known: dict[str, int]) -> list[int]:
    """Numbers of a text's words. A long text is read part by part, cut at blanks, where no word and no normal form spans."""
    ids: list[int] = []
    at = 0
    while at < len(text):
        end = at + PART
        while end < len(text) and text[end] not in " \n":
            end += 1
        ids += [known[w] for w in words(text[at:end])]
        at = end
    return ids


def gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of each run of n numbers, modulo 2**64 (collisions fall to the verification)."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + x[i : len(x) - n + 1 + i]
    return out


def pieces_of(passage: int, budget: int) -> list[tuple[int, int]]:
    """(offset, length) of the budget + 1 pieces of a passage, as equal as can be."""
    edges = [i * passage // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def myers(patterns: np.ndarray, texts: np.ndarray, limit: int) -> np.ndarray:
    """Least edit distance between each pattern and any stretch of its text, row by row; limit + 1 if above limit.

    Bit-parallel after Myers: one machine word holds the column of vertical
    differences of one row; patterns are at most 64 numbers long. 0 in a text
    equals nothing.
    """
    n, m = patterns.shape
    if m > 64:
        raise ValueError("patterns are at most 64 words long")
    one, top = np.uint64(1), np.uint64(m - 1)
    bits = one << np.arange(m, dtype=np.uint64)
    pv, mv = np.full(n, np.uint64(2**64 - 1)), np.zeros(n, np.uint64)
    score = np.full(n, m, np.int64)
    best = score.copy()
    for j in range(texts.shape[1]):
        symbol = texts[:, j, None]
        eq = ((patterns == symbol) & (symbol != 0)) @ bits
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph, mh = ph << one, mh << one
        pv, mv = mh | ~(xv | ph), ph & xv
        np.minimum(best, score, out=best)
    return np.minimum(best, limit + 1)


def _flat(texts: list[str | None], known: dict[str, int], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of many texts one after the other, each between gaps of zeros, and the text of each place."""
    parts, owners = [np.zeros(gap, np.uint64)], [np.zeros(gap, np.int64)]
    for i, text in enumerate(texts):
        ids = word_ids(text, known) if text else []
        if ids:
            parts += [np.array(ids, np.uint64), np.zeros(gap, np.uint64)]
            owners.append(np.full(len(ids) + gap, i, np.int64))
    return np.concatenate(parts), np.concatenate(owners)


def _runs(ids: np.ndarray, n: int) -> np.ndarray:
    """Places where a run of n words begins."""
    empty = np.concatenate([[0], np.cumsum(ids == 0)])
    return np.flatnonzero(empty[n:] == empty[:-n]) if len(ids) >= n else np.empty(0, np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a column of bytes."""
    n, width = rows.shape[0], rows.shape[1] * rows.itemsize
    offsets = (np.arange(n + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _numbers(column: pa.Array, n: int) -> np.ndarray:
    """A column of n numbers as bytes, as a matrix."""
    begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(column.buffers()[2] or b"", np.uint64, len(column) * n, int(begin)).reshape(len(column), n)


def _keyed(hashes: np.ndarray, piece: int) -> np.ndarray:
    """Hashes of one kind of piece, apart from those of others."""
    x = (hashes ^ np.uint64(piece + 1)) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _kinds(passage: int, budget: int, short: list[int]) -> list[tuple[int, int, int, int]]:
    """(words of the passage, offset, length, edits) of each kind of piece. Passages of short items are a single piece."""
    return [(passage, offset, length, budget) for offset, length in pieces_of(passage, budget)] + [(n, 0, n, 0) for n in short]


def item_passages(items: DataFrame, passage: int, short: bool) -> DataFrame:
    """words (the numbers of a passage's words as bytes) and item_id, once each. An item of fewer words is one passage if short is set."""
    kind = items.schema["item_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers()
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                batch = whole.slice(at, 100)
                ids, owner = _flat(batch["text"].to_pylist(), known, 1)
                for n in range(1 if short else passage, passage + 1):
                    begins = _runs(ids, n)
                    if n < passage:
                        begins = begins[(ids[begins - 1] == 0) & (ids[begins + n] == 0)]  # whole items alone
                    if len(begins):
                        columns = [_binary(ids[begins[:, None] + np.arange(n)]), batch["item_id"].take(pa.array(owner[begins]))]
                        yield pa.RecordBatch.from_arrays(columns, names=["words", "item_id"])

    return items.mapInArrow(cut, f"words binary, item_id {kind.simpleString()}").distinct()


def _pieces(passages: DataFrame, kinds: list[tuple[int, int, int, int]]) -> DataFrame:
    """hash, kind and words: each piece of each distinct passage."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch["words"])
            for k, (n, offset, length, _) in enumerate(kinds):
                mine = batch["words"].filter(pc.equal(sizes, n * 8))
                if len(mine):
                    hashes = gram_hashes(_numbers(mine, n)[:, offset : offset + length].reshape(-1), length)[::length]
                    yield pa.RecordBatch.from_arrays([pa.array(_keyed(hashes, k).view(np.int64)), pa.array(np.full(len(mine), k, np.int32)), mine], names=["hash", "kind", "words"])

    return passages.select("words").distinct().mapInArrow(cut, "hash bigint, kind int, words binary")


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def hash_filter(hashes: DataFrame, bits: int) -> bytes:
    """Bit filter of a column hash. Its size is fixed by bits, whatever the number of rows; tasks fill it, page by page it is merged."""
    width = min(bits >> 3, 1 << 13)  # bytes of a page
    count = (bits >> 3) // width

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            for at in _places(batch["hash"].to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(held, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))
        rows = held.reshape(count, width)
        full = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([rows[i].tobytes() for i in full], pa.binary())], names=["page", "content"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, content in zip(batch["page"].to_pylist(), batch["content"], strict=True):
                x = np.frombuffer(content.as_buffer(), np.uint8)
                held[page] = held[page] | x if page in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["page", "content"])

    schema = "page bigint, content binary"
    merged = hashes.select("hash").mapInArrow(fill, schema).repartition("page").mapInArrow(merge, schema)
    whole = np.zeros((count, width), np.uint8)
    for row in merged.toLocalIterator():
        whole[row.page] = np.frombuffer(row.content, np.uint8)
    return whole.tobytes()


def _scanner(shipped, bits: int, kinds: list[tuple[int, int, int, int]]):
    """Places of texts whose piece may be one of an item: hash, doc_id and the words that the passage can cover there."""
    gap = max(n + edits for n, _, _, edits in kinds)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shipped.value, np.uint8)
        known = _Numbers()
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                ids, owner = _flat(batch["text"].to_pylist(), known, gap)
                for k, (n, offset, length, edits) in enumerate(kinds):
                    at = _runs(ids, length)
                    if not len(at):
                        continue
                    hashes = _keyed(gram_hashes(ids, length)[at], k)
                    for bit in (0, 1):
                        place = _places(hashes, bits)[bit]
                        good = (held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        at, hashes = at[good], hashes[good]
                    for a in range(0, len(at), AT_ONCE):
                        some = slice(a, a + AT_ONCE)
                        around = ids[(at[some] - offset - edits)[:, None] + np.arange(n + 2 * edits)]
                        columns = [pa.array(hashes[some].view(np.int64)), batch["doc_id"].take(pa.array(owner[at[some]])), _binary(around)]
                        yield pa.RecordBatch.from_arrays(columns, names=["hash", "doc_id", "around"])

    return scan


def _verifier(kinds: list[tuple[int, int, int, int]]):
    """doc_id, words and distance of the hits that hold a passage."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k, (n, _, _, edits) in enumerate(kinds):
                mine = whole.filter(pc.equal(whole["kind"], k))
                for a in range(0, mine.num_rows, AT_ONCE):
                    batch = mine.slice(a, AT_ONCE)
                    distance = myers(_numbers(batch["words"], n), _numbers(batch["around"], n + 2 * edits), edits)
                    good = pa.array(distance <= edits)
                    if pc.any(good).as_py():
                        yield pa.RecordBatch.from_arrays([batch["doc_id"].filter(good), batch["words"].filter(good), pa.array(distance.astype(np.int32)).filter(good)], names=["doc_id", "words", "distance"])

    return verify


def find_leaks(docs: DataFrame, items: DataFrame, passage: int = PASSAGE, budget: int = BUDGET, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", short: bool = False, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, item_id and distance of each text that holds a passage of an item with at most budget word edits.

    distance is the least number of words inserted, deleted or changed over all
    passages; 0 means that `passage` words in a row are the same. Items of fewer
    words than a passage have none, or with short are one passage as a whole,
    which must stand unchanged. Null and empty texts hold none; rows with a null
    id are left out. Of repeated ids every row counts.
    """
    if not 0 <= budget < passage <= 64:
        raise ValueError("the budget must be smaller than the passage, which has at most 64 words")
    ship(docs.sparkSession)
    wanted = items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kept = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    passages = materialize(item_passages(wanted, passage, short), "leak-passages")
    lengths = sorted(r.n for r in passages.select(F.expr("octet_length(words) div 8").alias("n")).distinct().collect())  # at most `passage` of them
    kinds = _kinds(passage, budget, [n for n in lengths if n < passage])
    pieces = materialize(_pieces(passages, kinds), "leak-pieces")
    bits = 1 << min(filter_bits.bit_length() - 1, max(16, (pieces.count() * BITS_PER_PIECE).bit_length()))
    shipped = docs.sparkSession.sparkContext.broadcast(hash_filter(pieces, bits))
    id_type = kept.schema["doc_id"].dataType.simpleString()
    places = kept.mapInArrow(_scanner(shipped, bits, kinds), f"hash bigint, doc_id {id_type}, around binary")
    hits = lookup_join(places, pieces, "hash").select("doc_id", "kind", "words", "around")
    held = hits.mapInArrow(_verifier(kinds), f"doc_id {id_type}, words binary, distance int").groupBy("doc_id", "words").agg(F.min("distance").alias("distance"))
    return lookup_join(held, passages, "words").groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))
