from __future__ import annotations

import os
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import tokens

RANKS = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no rank files here")


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder(tokens.rank_file_bytes(RANKS))


@given(st.text(max_size=300))
@settings(max_examples=200, deadline=None)
def test_same_as_the_library_and_back(text):
    enc = tokens.encoder(tokens.rank_file_bytes(RANKS))
    ids = enc.encode(text)
    clean = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    assert ids == enc.encoding.encode_ordinary(clean)
    assert enc.decode_bytes(ids) == clean.encode()


@given(st.text(alphabet="ab 1\n\t.'sé　\x1c\x85", min_size=1, max_size=120), st.integers(4, 20))
@settings(max_examples=300, deadline=None)
def test_segments_do_not_change_ids(text, size):
    enc = tokens.encoder(tokens.rank_file_bytes(RANKS))
    parts = list(tokens.safe_segments(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in enc.encoding.encode_ordinary(p)] == enc.encoding.encode_ordinary(text)


@given(st.binary(min_size=1, max_size=200))
@settings(max_examples=200, deadline=None)
def test_merge_piece_is_the_librarys(piece):
    enc = tokens.encoder(tokens.rank_file_bytes(RANKS))
    assert tokens.merge_piece(piece, enc.ranks) == enc.encoding._encode_single_piece(piece) or piece in enc.ranks


def test_long_texts(enc):
    rng = random.Random(0)
    prose = " ".join(rng.choice(["robot", "arm", "Ünïcode", "12345", "…", "測試"]) for _ in range(60_000))
    assert enc.encode(prose) == enc.encoding.encode_ordinary(prose)
    for text in ("a" * 300_000, "測" * 200_000, " " * 300_000, "\n" * 100_000 + "x", "ab" * 5_000 + " " * 9_000 + "c"):
        began = time.time()
        ids = enc.encode(text)
        assert time.time() - began < 20
        assert enc.decode_bytes(ids) == text.encode()
    for text in ("xyz" * 3_000, " " * 6_000 + "a", "測試" * 2_500):
        assert enc.encode(text) == enc.encoding.encode_ordinary(text)


def test_table(spark):
    df = spark.createDataFrame([(1, "Hello world", 0), (2, "", 0), (3, None, 0), (4, "<|endoftext|>", 0), (1, "Hello world", 0), (None, " ", 0)], "doc_id bigint, text string, ids int")
    got = tokens.token_ids(df)
    rows = sorted(((r.doc_id, list(r.ids)) for r in got.collect()), key=repr)
    assert rows.count((1, [15496, 995])) == 2 and (2, []) in rows and (3, []) in rows and (None, [220]) in rows
    assert 50256 not in dict(rows)[4]
    back = {(r.doc_id, bytes(r.content)) for r in tokens.token_bytes(got).collect()}
    assert back == {(1, b"Hello world"), (2, b""), (3, b""), (4, b"<|endoftext|>"), (None, b" ")}
    assert tokens.token_ids(df.limit(0)).count() == 0


def test_rank_files_have_a_bound(tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\n")
    assert tokens.rank_file_bytes(str(path)) == b"YQ== 0\n"
    monkeypatch.setattr(tokens, "RANK_FILE_LIMIT", 3)
    with pytest.raises(ValueError):
        tokens.rank_file_bytes(str(path))
