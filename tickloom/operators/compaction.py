"""Far too many small files: consolidation by byte-level concatenation.

Bodies are joined as bytes, without parsing: a newline is put where a file ends
without one, a byte order mark at a file's head is taken off; files of complete
zstandard frames are joined as they are. Outputs have between half and one and a
half times the wished size, one file each on disk, and lengths and checksums
noted while writing are compared with the bytes read back. Records are read once,
after consolidation, to keep one of each; the kept lines are then concatenated
again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.runtime import ship
from tickloom.sources.files import move_in, place

BOM = b"\xef\xbb\xbf"
#: Bytes of an output file, and of one row that carries a part of it.
TARGET_BYTES = 128 << 20
CHUNK_BYTES = 4 << 20
#: Outputs that one task fills one after the other, on average: so their sizes do not hang on chance.
OUTPUTS_AT_ONCE = 8

CHUNK_SCHEMA = "out_file bigint, part int, content binary, n_files bigint, n_bytes bigint, source_bytes bigint, checksum bigint"
MANIFEST = "_manifest"


class LengthMismatch(ValueError):
    """What was consolidated or written does not have the bytes of its pieces."""


def join_pieces(pieces: list[bytes]) -> tuple[bytes, int]:
    """Join newline-delimited bodies; the result ends with a newline. Also the bytes taken from the pieces.

    Nothing but added newlines and dropped marks differs, which is checked by length.
    """
    parts, taken, changed = [], 0, 0
    for piece in pieces:
        taken += len(piece)
        body = piece
        if body.startswith(BOM):
            body = body[len(BOM) :]
            changed -= len(BOM)
        if not body:
            continue
        parts.append(body)
        if not body.endswith(b"\n"):
            parts.append(b"\n")
            changed += 1
    joined = b"".join(parts)
    if len(joined) != taken + changed:
        raise LengthMismatch(f"{len(joined)} bytes joined, {taken + changed} expected")
    return joined, taken


def zstd_frames_end(data: bytes) -> int:
    """Bytes of data taken by complete zstandard frames, from the headers alone; nothing is decompressed."""
    at = 0
    while at + 4 <= len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # skippable frame
            if at + 8 > len(data):
                return at
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        elif magic == 0xFD2FB528:
            if at + 5 > len(data):
                return at
            flags = data[at + 4]
            single, content = flags >> 5 & 1, flags >> 6
            end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single if content == 0 else (0, 2, 4, 8)[content])
            while True:
                if end + 3 > len(data):
                    return at
                head = int.from_bytes(data[end : end + 3], "little")
                end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
                if head & 1:
                    break
            end += 4 * (flags >> 2 & 1)
        else:
            return at
        if end > len(data):
            return at
        at = end
    return at


def join_zstd(pieces: list[bytes]) -> bytes:
    """Concatenate compressed files; zstandard readers take frame after frame. An incomplete file is an error."""
    for i, piece in enumerate(pieces):
        if (end := zstd_frames_end(piece)) != len(piece):
            raise LengthMismatch(f"piece {i} has complete frames up to byte {end} of {len(piece)}")
    return b"".join(pieces)


def _held(files: DataFrame, key: str, body: str) -> DataFrame:
    return files.select(F.col(key).cast("string").alias("key"), F.col(body).cast("binary").alias("body")).where(F.octet_length("body") > 0)


def _total_bytes(files: DataFrame, body: str, size: str | None) -> int:
    """About the bytes of all files: by their listed sizes, where unknown the mean of the known, or else by reading them."""
    if size is not None:
        n, known, total = files.agg(F.count("*"), F.count(size), F.coalesce(F.sum(size), F.lit(0))).first()
        if known:
            return int(total) * n // known
    return int(files.agg(F.coalesce(F.sum(F.octet_length(F.col(body).cast("binary"))), F.lit(0))).first()[0])


def consolidate(files: DataFrame, target_bytes: int = TARGET_BYTES, key: str = "file_id", body: str = "body", size: str | None = None, frames: bool = False) -> DataFrame:
    """Join small files into about total / target_bytes output files of half to one and a half times target_bytes.

    Each row of the result is a part of one output file; the parts of an output
    follow one another in one partition. Files go to tasks by the hash of key and
    body, which fill outputs one after the other; a file of half of target_bytes
    or more is an output of its own. Only if the other files of a task together
    have less than that is an output smaller. size names a column of file sizes,
    from which the plan is made without reading bodies. Null and empty bodies
    hold nothing and are left out. Rows with a null key are files like any
    other. An empty table gives no parts.

    frames: bodies are files of complete zstandard frames. Others cannot be
    joined and are left out; see incomplete_frames().
    """
    ship(files.sparkSession)
    held = _held(files, key, body)
    if frames:
        held = held.where(_complete("body"))
    groups = max(1, round(_total_bytes(files, body, size) / (target_bytes * OUTPUTS_AT_ONCE)))
    planned = held.withColumn("task", F.pmod(F.xxhash64(F.coalesce("key", F.lit("")), "body"), F.lit(groups)))
    ordered = planned.repartition("task").sortWithinPartitions("task", "key", "body")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _join(batches, target_bytes, frames)

    return ordered.mapInArrow(join, CHUNK_SCHEMA)


def _complete(body: str) -> Column:
    @F.pandas_udf("boolean")
    def complete(bodies):
        return bodies.map(lambda x: x is not None and zstd_frames_end(bytes(x)) == len(x))

    return complete(F.col(body))


def incomplete_frames(files: DataFrame, key: str = "file_id", body: str = "body") -> DataFrame:
    """The keys of files that hold anything but complete zstandard frames."""
    ship(files.sparkSession)
    return _held(files, key, body).where(~_complete("body")).select(F.col("key").alias(key))


class _Outputs:
    """Fills the outputs of one task after another; what an output would get beyond its size is kept back until it is clear that it makes one itself."""

    def __init__(self, target: int, frames: bool):
        self.target, self.frames = target, frames
        self.task, self.number = -1, 0
        self.rows: list[dict] = []
        self.begin(-1)

    def begin(self, task: int) -> None:
        self.task, self.number, self.next = task, 0, 1
        self.part, self.size = 0, 0
        self.pieces: list[bytes] = []
        self.pieces_size = 0
        self.kept: list[bytes] = []
        self.kept_size = 0

    def _name(self, number: int) -> int:
        return (self.task << 24) + number

    def _emit(self, number: int, part: int, pieces: list[bytes]) -> None:
        content, taken = (b"".join(pieces), sum(map(len, pieces))) if self.frames else join_pieces(pieces)
        if content:
            self.rows.append({"out_file": self._name(number), "part": part, "content": content, "n_files": len(pieces), "n_bytes": len(content), "source_bytes": taken, "checksum": zlib.crc32(content)})

    def _put(self, piece: bytes) -> None:
        if self.pieces and self.pieces_size + len(piece) > CHUNK_BYTES:
            self._close_part()
        self.pieces.append(piece)
        self.pieces_size += len(piece)
        self.size += len(piece)

    def _close_part(self) -> None:
        if self.pieces:
            self._emit(self.number, self.part, self.pieces)
            self.part += 1
            self.pieces, self.pieces_size = [], 0

    def add(self, piece: bytes) -> None:
        if len(piece) * 2 >= self.target:
            self._emit(self.next, 0, [piece])
            self.next += 1
        elif self.size + len(piece) <= self.target:
            self._put(piece)
        else:
            self.kept.append(piece)
            self.kept_size += len(piece)
            if self.kept_size * 2 >= self.target:
                self._close_part()
                kept = self.kept
                self.number, self.next = self.next, self.next + 1
                self.part, self.size, self.kept, self.kept_size = 0, 0, [], 0
                for x in kept:
                    self._put(x)

    def end(self) -> None:
        for x in self.kept:
            self._put(x)
        self._close_part()

    def taken(self) -> Iterator[dict]:
        rows, self.rows = self.rows, []
        yield from rows


def _join(batches: Iterator[pa.RecordBatch], target: int, frames: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("out_file", pa.int64()), ("part", pa.int32()), ("content", pa.binary()), ("n_files", pa.int64()), ("n_bytes", pa.int64()), ("source_bytes", pa.int64()), ("checksum", pa.int64())]
    )
    outputs = _Outputs(target, frames)
    for batch in batches:
        for task, body in zip(batch["task"].to_pylist(), batch["body"], strict=True):
            if task != outputs.task:
                outputs.end()
                yield from (pa.RecordBatch.from_pylist([r], schema=schema) for r in outputs.taken())
                outputs.begin(task)
            outputs.add(body.as_buffer().to_pybytes())
            yield from (pa.RecordBatch.from_pylist([r], schema=schema) for r in outputs.taken())
    outputs.end()
    yield from (pa.RecordBatch.from_pylist([r], schema=schema) for r in outputs.taken())


def _whole(x: object) -> int | None:
    """A JSON number as an integer by value; None if it has none."""
    if isinstance(x, bool) or not isinstance(x, int | float):
        return None
    if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf")) or x != int(x)):
        return None
    return int(x) if -(1 << 63) <= x < 1 << 63 else None


def read_record(line: bytes) -> tuple[int, int, bytes] | None:
    """episode_index, length and the bare line, if the line is a complete JSON object with both whole numbers."""
    text = line.decode("utf-8", "replace").strip().strip("﻿").strip()
    if not text.startswith("{"):
        return None
    try:
        record = json.loads(text)
    except ValueError:
        return None
    episode, length = _whole(record.get("episode_index")), _whole(record.get("length"))
    return None if episode is None or length is None else (episode, length, text.encode("utf-8"))


def records(chunks: DataFrame) -> DataFrame:
    """The records in consolidated parts: episode_index, length, line, and place (order in the outputs)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["episode_index", "length", "line", "out_file", "part", "number"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        for batch in batches:
            for out, part, content in zip(batch["out_file"].to_pylist(), batch["part"].to_pylist(), batch["content"], strict=True):
                found = [(*r, out, part, i) for i, line in enumerate(content.as_buffer().to_pybytes().splitlines()) if (r := read_record(line))]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    ship(chunks.sparkSession)
    return chunks.mapInArrow(read, "episode_index bigint, length bigint, line binary, out_file bigint, part int, number int")


def unique_records(files: DataFrame, target_bytes: int = TARGET_BYTES, size: str | None = None) -> DataFrame:
    """Every record of the files once: episode_index, length, line (the first in output order).

    A record is a line that is a complete JSON object with whole-number
    episode_index and length, blanks and a byte order mark aside; numbers are
    compared by value (40 and 40.0 are equal). Interrupted lines are none.
    """
    found = records(consolidate(files, target_bytes, size=size))
    return found.groupBy("episode_index", "length").agg(F.min_by("line", F.struct("out_file", "part", "number")).alias("line"))


def compact(files: DataFrame, target_bytes: int = TARGET_BYTES, size: str | None = None) -> DataFrame:
    """The well-sized files: parts as of consolidate(), holding every record exactly once."""
    lines = unique_records(files, target_bytes, size).select(F.concat_ws("/", "episode_index", "length").alias("file_id"), F.col("line").alias("body"))
    return consolidate(lines, target_bytes)


def write_compacted(chunks: DataFrame, path: str, suffix: str = ".jsonl") -> DataFrame:
    """Write parts as of consolidate(), one file per output, and return the manifest: out_file, name, n_bytes, checksum.

    Files get their names when complete, so a repeated or lost task leaves no
    second copy; the manifest, below path too, is written last, by Spark's
    committer. A path that has one already is refused.
    """
    spark = chunks.sparkSession
    ship(spark)
    fs, base, _ = place(path)
    if fs.get_file_info(f"{base}/{MANIFEST}/_SUCCESS").type:
        raise FileExistsError(f"{path} holds files already")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base, _ = place(path)
        rows = ((out, content) for batch in batches for out, content in zip(batch["out_file"].to_pylist(), batch["content"], strict=True))
        row = next(rows, None)
        while row is not None:
            now, name = row[0], f"out-{row[0]:012d}{suffix}"
            size = checksum = 0

            def fill(part: str, now: int = now) -> None:
                nonlocal row, size, checksum
                with fs.open_output_stream(part, compression=None) as f:
                    while row is not None and row[0] == now:
                        data = row[1].as_buffer().to_pybytes()
                        f.write(data)
                        size, checksum = size + len(data), zlib.crc32(data, checksum)
                        row = next(rows, None)

            move_in(fs, f"{base}/{name}", fill)
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([name]), pa.array([size]), pa.array([checksum])], names=["out_file", "name", "n_bytes", "checksum"])

    ordered = chunks.select("out_file", "part", "content").sortWithinPartitions("out_file", "part").select("out_file", "content")
    target = path if "://" in path else f"file://{base}"
    ordered.mapInArrow(write, "out_file bigint, name string, n_bytes bigint, checksum bigint").write.mode("overwrite").parquet(f"{target}/{MANIFEST}")
    return spark.read.parquet(f"{target}/{MANIFEST}")


def read_back(manifest: DataFrame, path: str) -> DataFrame:
    """The manifest with what is on disk: found_bytes, found_checksum and lines of each file; null where there is none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base, _ = place(path)
        for batch in batches:
            found: list[tuple] = []
            for name in batch["name"].to_pylist():
                if not fs.get_file_info(f"{base}/{name}").type:
                    found.append((None, None, None))
                    continue
                size = checksum = lines = 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    while data := f.read(CHUNK_BYTES):
                        size, checksum, lines = size + len(data), zlib.crc32(data, checksum), lines + data.count(b"\n")
                found.append((size, checksum, lines))
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("out_file", "name", "n_bytes", "checksum")), *columns], names=["out_file", "name", "n_bytes", "checksum", "found_bytes", "found_checksum", "lines"])

    ship(manifest.sparkSession)
    rows = manifest.select("out_file", "name", "n_bytes", "checksum").where("name is not null")
    return rows.mapInArrow(read, "out_file bigint, name string, n_bytes bigint, checksum bigint, found_bytes bigint, found_checksum bigint, lines bigint")


def verify_compacted(spark: SparkSession, chunks: DataFrame, path: str) -> dict[str, int]:
    """Compare what is on disk with the checksums noted while writing, and those with the parts: outputs, bytes, each part's checksum.

    Raises LengthMismatch if anything differs. chunks are computed again, unless they are a table.
    """
    _, base, _ = place(path)
    manifest = spark.read.parquet(f"{path if '://' in path else f'file://{base}'}/{MANIFEST}")
    disk = read_back(manifest, path)
    wrong = disk.where("not (n_bytes <=> found_bytes and checksum <=> found_checksum)").limit(5).collect()
    if wrong:
        raise LengthMismatch(f"on disk is not what was written: {[r.name for r in wrong]}")
    want = chunks.groupBy("out_file").agg(F.sum("n_bytes").alias("want"))
    wrong = want.join(manifest, "out_file", "full").where("not (want <=> n_bytes)").limit(5).collect()
    if wrong:
        raise LengthMismatch(f"outputs differ from their parts: {[(r.out_file, r.want, r.n_bytes) for r in wrong]}")
    got = disk.agg(F.coalesce(F.sum("found_bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("lines"), F.lit(0)).alias("n"), F.count("*").alias("f")).first()
    return {"bytes": got.b, "records": got.n, "files": got.f}
