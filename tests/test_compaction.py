from __future__ import annotations

import json
import random

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.operators import compaction as c

FILES = "file_id bigint, rel_path string, body string, size_bytes bigint, written_at timestamp, line int"


def frame(spark, bodies):
    return spark.createDataFrame([(i, f"p{i}", b, None, None, 1) for i, b in enumerate(bodies)], FILES).repartition(3)


def rec(e, n, **more):
    return json.dumps({"episode_index": e, "length": n, **more})


@given(st.lists(st.binary(max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_join_pieces_keeps_every_line(pieces):
    joined, taken = c.join_pieces(pieces)
    want = b"".join((p[3:] if p.startswith(c.BOM) else p) + (b"" if p.endswith(b"\n") or not p[3 * p.startswith(c.BOM) :] else b"\n") for p in pieces)
    assert joined == want
    assert taken == sum(map(len, pieces))


def test_zstd_frames():
    z = zstandard.ZstdCompressor(write_checksum=True)
    raw = [b"a" * 100_000, b"", b"hello\n", bytes(range(256)) * 999]
    pieces = [z.compress(x) for x in raw] + [zstandard.ZstdCompressor(write_content_size=False).compress(b"tail")]
    whole = c.join_zstd(pieces)
    assert zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read() == b"".join(raw) + b"tail"
    assert c.zstd_frames_end(whole[:-2]) == len(whole) - len(pieces[-1])
    for broken in (pieces[0][:-1], pieces[0] + b"x", b"plain"):
        with pytest.raises(c.LengthMismatch):
            c.join_zstd([pieces[1], broken])


def test_records_of_all_forms(spark):
    bodies = [
        rec(1, 10) + "\n" + rec(2, 20),
        "﻿" + rec(1, 10.0, task="ü") + "\r\n\r\n" + rec(3, 5) + "\r" + rec(4, 6) + "\n",
        rec(1, 11) + '\n{"episode_index": 9, "leng',
        None, "", "   \n\t\n", '{"episode_index": 7}', "[1, 2]", '{"episode_index": true, "length": 3}', '{"episode_index": 5, "length": 1.5}', '{"episode_index": "5", "length": 1}',
        "  " + rec(2, 20) + "  ",
    ]
    got = c.unique_records(frame(spark, bodies)).select("episode_index", "length").collect()
    assert sorted(map(tuple, got)) == [(1, 10), (1, 11), (2, 20), (3, 5), (4, 6)]


def test_compact_writes_each_record_once(spark, tmp_path):
    bodies = [rec(i % 50, i % 7, pad="x" * 50) + ("\n" if i % 3 else "") for i in range(400)]
    parts = c.compact(frame(spark, bodies), target_bytes=4000)
    path = str(tmp_path / "out")
    c.write_compacted(parts, path)
    seen = c.verify_compacted(spark, parts, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    keys = [(x["episode_index"], x["length"]) for x in lines]
    assert seen["records"] == len(keys) == len(set(keys)) == len({(i % 50, i % 7) for i in range(400)})
    assert 2 <= parts.select("out_file").distinct().count() <= 12


def test_files_on_disk_are_well_sized(spark, tmp_path):
    rng = random.Random(3)
    for n, low, high, target in ((2000, 200, 900, 20_000), (300, 10, 19_000, 20_000), (3, 10, 20, 20_000)):
        bodies = ["x" * rng.randrange(low, high) + "\n" for _ in range(n)]
        parts = c.consolidate(frame(spark, bodies), target)
        path = tmp_path / f"{n}"
        manifest = c.write_compacted(parts, str(path))
        sizes = [f.stat().st_size for f in path.glob("out-*")]
        total = sum(map(len, bodies))
        assert sum(sizes) == total and len(sizes) == manifest.count() == len({r.out_file for r in manifest.collect()})
        if total > target:
            assert all(0.5 * target <= x <= 1.5 * target for x in sizes), sorted(sizes)
        else:
            assert len(sizes) == 1
        assert c.verify_compacted(spark, parts, str(path)) == {"bytes": total, "records": n, "files": len(sizes)}
        with pytest.raises(FileExistsError):
            c.write_compacted(parts, str(path))


@pytest.mark.parametrize("harm", ["flip", "cut", "gone"])
def test_harm_on_disk_is_noticed(spark, tmp_path, harm):
    parts = c.consolidate(frame(spark, ["x" * 500] * 40), 4000)
    c.write_compacted(parts, str(tmp_path / "out"))
    victim = sorted((tmp_path / "out").glob("out-*"))[1]
    data = bytearray(victim.read_bytes())
    if harm == "flip":
        data[7] ^= 1
    victim.write_bytes(data[:-1] if harm == "cut" else data)
    if harm == "gone":
        victim.unlink()
    with pytest.raises(c.LengthMismatch, match=victim.name):
        c.verify_compacted(spark, parts, str(tmp_path / "out"))


def test_sizes_of_a_listing_make_the_plan(spark):
    bodies = ["y" * 99 + "\n"] * 200
    listed = frame(spark, bodies).selectExpr("file_id", "body", "if(file_id % 3 = 0, null, 100) AS size_bytes")
    with_sizes = c.consolidate(listed, 1000, size="size_bytes").groupBy("out_file").sum("n_bytes").collect()
    assert sorted(r[1] for r in with_sizes) == sorted(r[1] for r in c.consolidate(listed, 1000).groupBy("out_file").sum("n_bytes").collect())
    assert c.consolidate(listed.withColumn("size_bytes", F.lit(None).cast("bigint")), 1000, size="size_bytes").count() > 10


def test_frames_are_joined_as_they_are(spark, tmp_path):
    z = zstandard.ZstdCompressor(write_checksum=True)
    raw = [bytes([97 + i % 20]) * (50 + i) for i in range(120)]
    packed = [bytearray(z.compress(x)) for x in raw]
    rows = [(i, packed[i]) for i in range(120)] + [(200, packed[3][:-2]), (201, bytearray(b"plain")), (202, None), (203, bytearray())]
    files = spark.createDataFrame(rows, "file_id bigint, body binary").repartition(3)
    parts = c.consolidate(files, 600, frames=True)
    c.write_compacted(parts, str(tmp_path / "z"), suffix=".zst")
    names = sorted((tmp_path / "z").glob("*.zst"))
    got = b"".join(zstandard.ZstdDecompressor().stream_reader(f.read_bytes(), read_across_frames=True).read() for f in names)
    assert sorted(got) == sorted(b"".join(raw)) and len(names) > 3 and all(300 <= f.stat().st_size <= 900 for f in names)
    assert c.verify_compacted(spark, parts, str(tmp_path / "z"))["files"] == len(names)
    assert sorted(r.file_id for r in c.incomplete_frames(files).collect()) == ["200", "201"]


def test_large_file_is_an_output_of_its_own(spark):
    parts = c.consolidate(frame(spark, [rec(1, 1) * 1, "y" * 5000, rec(2, 2)]), target_bytes=1000).collect()
    big = [r for r in parts if r.n_bytes > 5000]
    assert len(big) == 1 and big[0].n_files == 1
    assert sum(r.source_bytes for r in parts) == 5000 + 2 * len(rec(1, 1))


def test_empty(spark):
    assert c.compact(frame(spark, [])).count() == 0
    assert c.unique_records(frame(spark, [None, ""])).count() == 0


def test_mismatch_is_noticed(spark, tmp_path):
    parts = c.compact(frame(spark, [rec(1, 1), rec(2, 2)]))
    c.write_compacted(parts.limit(0), str(tmp_path / "x"))
    with pytest.raises(c.LengthMismatch):
        c.verify_compacted(spark, parts, str(tmp_path / "x"))
