"""Encoding of texts with a public byte-level BPE tokenizer, from a local rank file.

Texts are encoded in Arrow batches. A long text is cut where the pattern that
splits text before the merges always splits it, so the ids are those of the
whole text. Decoding works on raw bytes, since a token may end inside a code
point.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tickloom.runtime import ship

TOKENIZERS = os.environ.get("TICKLOOM_TOKENIZERS", "/opt/tokenizers")

#: Fixed value: the public pattern that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Code points of a text that are encoded in one call.
SEGMENT = 1 << 16
#: Bytes of a piece between two splits from which the merges are done by merge_piece.
LONG_PIECE = 1 << 12

#: A place where a blank or newline follows a non-space; stricter than any reading of white space.
SAFE_CUT = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n]")

#: Bytes of a rank file, at most.
RANK_FILE_LIMIT = 32 << 20

_encodings: dict = {}


def rank_file_bytes(path: str) -> bytes:
    """The rank file, read on the driver; executors get its bytes and need no copy of the file."""
    if (size := os.path.getsize(path)) > RANK_FILE_LIMIT:
        raise ValueError(f"{path} has {size} bytes; rank files of more than {RANK_FILE_LIMIT} are not sent to executors")
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """The content of a rank file with tiktoken's merges, for texts of any length."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.encoding = tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.pieces = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens; null and empty texts have none, []. Lone surrogates become U+FFFD."""
        if not text:
            return []
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if not _clean(text) else text
        if len(text) <= SEGMENT:
            return self._segment(text)
        ids: list[int] = []
        for part in safe_segments(text, SEGMENT):
            ids += self._segment(part)
        return ids

    def _segment(self, text: str) -> list[int]:
        if len(text) < LONG_PIECE or not _long_run(text, LONG_PIECE):
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for match in self.pieces.finditer(text):
            piece = match.group().encode("utf-8")
            if piece in self.ranks:
                ids.append(self.ranks[piece])
            elif len(piece) < LONG_PIECE:
                ids += self.encoding.encode_ordinary(match.group()) if not match.group().isspace() else merge_piece(piece, self.ranks)
            else:
                ids += merge_piece(piece, self.ranks)
        return ids

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)


def _clean(text: str) -> bool:
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:
        return False
    return True


def _long_run(text: str, least: int) -> bool:
    """Whether some stretch of least code points has no place where the pattern splits for certain."""
    at = 0
    while at + least <= len(text):
        cut = _cut_before(text, at + least, at)
        if cut is None:
            return True
        at = cut
    return False


def _cut_before(text: str, end: int, begin: int) -> int | None:
    """The last i in (begin, end] where a blank or newline follows a non-space: no piece of the pattern spans it."""
    for i in range(min(end, len(text) - 1), begin, -1):
        if text[i] in " \n" and not text[i - 1].isspace():
            return i
    return None


def safe_segments(text: str, size: int) -> Iterator[str]:
    """Cut a text at places where the pattern always splits, into parts of about size; a part without such a place is longer."""
    at = 0
    while len(text) - at > size:
        cut = _cut_before(text, at + size, at)
        if cut is None:
            after = SAFE_CUT.search(text, at + size)
            if after is None:
                break
            cut = after.start()
        yield text[at:cut]
        at = cut
    yield text[at:]


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one piece: the pair of the lowest rank first, of equal ones the leftmost. O(n log n), for very long pieces."""
    import heapq

    n = len(piece)
    starts = list(range(n + 1))
    after, before, alive = list(range(1, n + 2)), list(range(-1, n)), [True] * (n + 1)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(piece[starts[i] : after[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end or ranks.get(piece[i:end]) != rank:
            continue
        j = after[i]
        alive[j] = False
        after[i] = end
        if end <= n - 1:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def encoder(content: bytes) -> Encoder:
    """The encoder of a rank file's content, built once per process."""
    key = hashlib.sha256(content).digest()
    if key not in _encodings:
        _encodings[key] = Encoder(content)
    return _encodings[key]


def token_ids(docs: DataFrame, rank_file: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of each row; null and empty texts have the ids []. Rows are kept one by one, repeats too."""
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(rank_file_bytes(rank_file or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ids = encoder(ranks.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [with_ids.encode(x) for x in part["text"].to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                flat = np.fromiter((i for x in found for i in x), np.int32, int(offsets[-1]))
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids], names=["doc_id", "ids"])

    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def token_bytes(ids: DataFrame, rank_file: str | None = None) -> DataFrame:
    """doc_id and the raw bytes that its ids stand for."""
    ship(ids.sparkSession)
    ranks = ids.sparkSession.sparkContext.broadcast(rank_file_bytes(rank_file or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ids = encoder(ranks.value)
        for batch in batches:
            found = [with_ids.decode_bytes(x or []) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.binary())], names=["doc_id", "content"])

    return ids.select("doc_id", "ids").mapInArrow(decode, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, content binary")
