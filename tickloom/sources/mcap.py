"""MCAP recordings as a Spark data source, by the public file format; one partition a file.

    read(spark, "/recordings", topics="/a,/b")

or, in any session,

    spark.dataSource.register(McapSource)
    spark.read.format("mcap").option("topics", "/a,/b").load("/recordings")

Columns: episode_id (the folder 'episode_<id>' of the file, else its path),
path, topic, log_time, seq (place in the file), value, data and format. Only
records of wanted topics are decoded; a filter on topic is pushed down where the
session allows it (option `pushdown`, which read() sets). A message becomes a
vector if its encoding is json (a list, or an object with a list `value`), f64
(little-endian doubles), protobuf (the field that the option `value_field` names,
by the file's own descriptors), or one that the option `decoders` names as
encoding=module:function, separated by commas; workers import the function, which
takes a message and its schema. Other bytes stay in `data`. Topics in the option `raw` are cameras:
`data` and `format` are those fields of a protobuf message (options `data_field`,
`format_field`), the whole message in other encodings. A file that breaks off or
holds a message that cannot be read gives what was read, then a row with `error`.

The path is local or a URI that Arrow knows (s3, s3a, gs, hdfs); files are read
from front to back, record by record. A path that does not exist is an error.
"""

from __future__ import annotations

import io
import json
import re
import struct
from collections.abc import Callable, Iterator
from importlib import import_module
from pathlib import Path
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tickloom.runtime import ship
from tickloom.sources.files import files_below, open_stream

# Fixed values of the file format.
MAGIC = b"\x89MCAP0\r\n"
SCHEMA, CHANNEL, MESSAGE, CHUNK, DATA_END = 3, 4, 5, 6, 15


def _json_vector(data: bytes, _: bytes) -> list[float] | None:
    x = json.loads(data)
    x = x.get("value") if isinstance(x, dict) else x
    return None if x is None else [float(v) for v in x]


def _f64_vector(data: bytes, _: bytes) -> list[float]:
    return list(struct.unpack(f"<{len(data) // 8}d", data))


Decoder = Callable[[bytes, bytes], list[float] | None]
#: Message encoding -> decoder of (message, schema) to a vector, of those that need no option.
DECODERS: dict[str, Decoder] = {"json": _json_vector, "f64": _f64_vector}


def decoder_at(place: str) -> Decoder:
    """The function that 'module:function' names."""
    module, _, name = place.partition(":")
    return getattr(import_module(module), name)


class BrokenFile(ValueError):
    """The file breaks off, or is none."""


def _text(b: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", b, at)
    return b[at + 4 : at + 4 + n].decode(), at + 4 + n


def _records(b: bytes, at: int) -> Iterator[tuple[int, bytes]]:
    while at + 9 <= len(b):
        op, n = struct.unpack_from("<BQ", b, at)
        if at + 9 + n > len(b):
            raise BrokenFile(f"a record of {n} bytes at {at} is cut off")
        yield op, b[at + 9 : at + 9 + n]
        at += 9 + n


def _streamed(f: BinaryIO) -> Iterator[tuple[int, bytes]]:
    while len(head := f.read(9)) == 9:
        op, n = struct.unpack("<BQ", head)
        body = f.read(n)
        if len(body) < n:
            raise BrokenFile(f"a record of {n} bytes is cut off after {len(body)}")
        yield op, body


def _inflate(name: str, data: bytes, size: int) -> bytes:
    if name == "":
        return data
    if name == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
    if name == "lz4":
        import pyarrow as pa

        return pa.Codec("lz4").decompress(data, size).to_pybytes()
    raise BrokenFile(f"unknown compression {name!r}")


def messages(content: bytes, topics: set[str] | None = None) -> Iterator[tuple[str, int, int, str, bytes, bytes]]:
    """(topic, log_time, seq, encoding, schema, data) of the wanted messages in file order."""
    for topic, log_time, seq, encoding, _, schema, data in streamed_messages(io.BytesIO(content), topics):
        yield topic, log_time, seq, encoding, schema, data


def streamed_messages(f: BinaryIO, topics: set[str] | None = None) -> Iterator[tuple[str, int, int, str, str, bytes, bytes]]:
    """(topic, log_time, seq, encoding, schema name, schema, data) of the wanted messages of a file that is read once, without seeking."""
    if f.read(len(MAGIC)) != MAGIC:
        raise BrokenFile("no MCAP file")
    schemas: dict[int, tuple[str, bytes]] = {}
    channels: dict[int, tuple[str, str, str, bytes]] = {}
    seq = 0

    def walk(records: Iterator[tuple[int, bytes]]) -> Iterator[tuple[str, int, int, str, str, bytes, bytes]]:
        nonlocal seq
        for op, r in records:
            if op == SCHEMA:
                (number,) = struct.unpack_from("<H", r)
                name, k = _text(r, 2)
                _, k = _text(r, k)
                schemas[number] = name, r[k + 4 :]
            elif op == CHANNEL:
                number, schema = struct.unpack_from("<HH", r)
                topic, k = _text(r, 4)
                encoding, k = _text(r, k)
                channels[number] = (topic, encoding, *schemas.get(schema, ("", b"")))
            elif op == MESSAGE:
                number, _, log_time, _ = struct.unpack_from("<HIQQ", r)
                if number not in channels:
                    raise BrokenFile(f"channel {number} is not declared")
                topic, encoding, kind, schema = channels[number]
                if topics is None or topic in topics:
                    yield topic, log_time, seq, encoding, kind, schema, r[22:]
                seq += 1
            elif op == CHUNK:
                _, _, size, _ = struct.unpack_from("<QQQI", r)
                name, k = _text(r, 28)
                yield from walk(_records(_inflate(name, r[k + 8 :], size), 0))
            elif op == DATA_END:
                return

    yield from walk(_streamed(f))


def write_mcap(path: str | Path, rows: list[tuple[str, int, bytes]], encoding: str = "f64", compression: str = "", schemas: dict[str, tuple[str, bytes]] | None = None) -> None:
    """Write (topic, log_time, data) messages as one chunk. schemas: topic -> message name and descriptors of topics in protobuf."""
    text = lambda s: struct.pack("<I", len(s)) + s.encode()
    record = lambda op, body: struct.pack("<BQ", op, len(body)) + body
    inner, numbers = b"", {}
    for i, (topic, log_time, data) in enumerate(rows):
        if topic not in numbers:
            numbers[topic] = len(numbers) + 1
            name, descriptors = (schemas or {}).get(topic, ("", b""))
            if name:
                inner += record(SCHEMA, struct.pack("<H", numbers[topic]) + text(name) + text("protobuf") + struct.pack("<I", len(descriptors)) + descriptors)
            inner += record(CHANNEL, struct.pack("<HH", numbers[topic], numbers[topic] if name else 0) + text(topic) + text("protobuf" if name else encoding) + struct.pack("<I", 0))
        inner += record(MESSAGE, struct.pack("<HIQQ", numbers[topic], i, log_time, log_time) + data)
    packed = inner
    if compression == "zstd":
        import zstandard

        packed = zstandard.ZstdCompressor().compress(inner)
    chunk = struct.pack("<QQQI", 0, 0, len(inner), 0) + text(compression) + struct.pack("<Q", len(packed)) + packed
    Path(path).write_bytes(MAGIC + record(1, text("") + text("tickloom")) + record(CHUNK, chunk) + record(DATA_END, struct.pack("<I", 0)) + MAGIC)


def episode_id(path: str) -> str:
    found = re.search(r"episode_([^/]+)", path)
    return found.group(1) if found else path


class _File(InputPartition):
    pass


class _McapReader(DataSourceReader):
    def __init__(self, options: dict):
        listed = lambda name: {t.strip() for t in options.get(name, "").split(",") if t.strip()}
        self.topics: set[str] | None = listed("topics") or None
        self.raw = listed("raw")
        self.root, self.suffix = options.get("path", ""), options.get("suffix", ".mcap")
        self.named: dict[str, str] = dict(part.strip().split("=", 1) for part in options.get("decoders", "").split(",") if part.strip())
        self.found: dict[str, Decoder] = {}
        self.value_field, self.data_field, self.format_field = (options.get(k, d) for k, d in (("value_field", "position"), ("data_field", "data"), ("format_field", "format")))

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in files_below(self.root, self.suffix)]

    def _decoded(self, topic: str, encoding: str, name: str, schema: bytes, data: bytes) -> tuple[list[float] | None, bytes | None, str | None]:
        """value, data and format of a message."""
        if encoding in self.named and topic not in self.raw:
            if encoding not in self.found:
                self.found[encoding] = decoder_at(self.named[encoding])
            return self.found[encoding](data, schema), None, None
        if encoding == "protobuf":
            from tickloom.sources import protobuf

            m = protobuf.parsed(data, name, schema)
            if topic in self.raw:
                return None, *protobuf.frame(m, self.data_field, self.format_field)
            value = protobuf.vector(m, self.value_field)
            return value, data if value is None else None, None
        decoder = None if topic in self.raw else DECODERS.get(encoding)
        return (decoder(data, schema), None, None) if decoder else (None, data, None)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        try:
            with open_stream(path) as f:
                for topic, log_time, seq, *message in streamed_messages(f, self.topics):
                    yield episode_id(path), path, topic, log_time, seq, *self._decoded(topic, *message), None
        except Exception as e:  # a decoder may raise anything; the file's other rows and other files go on
            yield episode_id(path), path, None, None, None, None, None, None, str(e) or type(e).__name__


class _PushingReader(_McapReader):
    """Takes filters on topic. A session that does not allow that refuses any reader with this method."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            names = {f.value} if isinstance(f, EqualTo) and f.attribute == ("topic",) else set(f.value) if isinstance(f, In) and f.attribute == ("topic",) else None
            if names is None:
                yield f
            else:
                self.topics = names if self.topics is None else self.topics & names


class McapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return "episode_id string, path string, topic string, log_time bigint, seq bigint, value array<double>, data binary, format string, error string"

    def reader(self, schema) -> DataSourceReader:
        return (_PushingReader if self.options.get("pushdown", "").lower() == "true" else _McapReader)(self.options)


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Recordings below path, with filters on topic pushed down if the session allows it."""
    ship(spark)
    spark.dataSource.register(McapSource)
    allowed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("mcap").options(**{"pushdown": allowed, **options}).load(path)
