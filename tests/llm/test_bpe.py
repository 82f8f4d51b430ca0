"""The transducer against tiktoken, pieces against whole matching, the decoder in all chunkings."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from lexloom.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.codec(PATH, P.PATTERN)


def same(text):
    ids = OURS.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == THEIRS.encode_ordinary(text)
    assert "".join(OURS.decode(ids, 3)) == text


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc dé'stll\n \t\r\x1c .,!19中😀", max_size=60))
def test_close_text(text):
    same(text)


@pytest.mark.parametrize("text", ["", "a" * 3000, "ab" * 999, "é" * 500, "\n\n  x\n y \n", "x  y", "don't we'll 12 345\n6", "<|endoftext|>", "中文" * 300])
def test_hard_text(text):
    same(text)


def test_few_states(monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 20)
    monkeypatch.setattr(bpe, "PIECES", 5)
    fst = bpe.Transducer(RANKS)
    for word in (" unbelievably", "internationalization" * 30, "Straßenbahnhaltestelle"):
        assert fst.encode(word.encode()) == THEIRS._encode_single_piece(word) == bpe.merge(word.encode(), RANKS)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=12), st.lists(st.integers(0, 12)))
def test_stream(data, cuts):
    stream, at = bpe.Utf8Stream(), [0, *sorted(c for c in cuts if c <= len(data)), len(data)]
    got = "".join(stream.feed(data[a:b]) for a, b in zip(at, at[1:])) + stream.feed(b"", True)
    assert got == data.decode("utf-8", "replace")


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=12))
def test_split_characters(data):
    ids = np.array([RANKS[bytes([b])] for b in data], "<u4").tobytes()
    assert "".join(OURS.decode(ids, 2)) == data.decode("utf-8", "replace")


def test_other_pattern():
    other = bpe.Codec(RANKS, r"\S|\s+")
    for text in ("one two", "a b\nc"):
        assert np.frombuffer(other.encode(text), "<u4").tolist() == tiktoken.Encoding("own", pat_str=r"\S|\s+", mergeable_ranks=RANKS, special_tokens={}).encode_ordinary(text)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in bpe.encode(docs, PATH, P.PATTERN).collect()}
    for d in docs.collect():
        ids, r = THEIRS.encode_ordinary(d.text), rows[d.doc_id]
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "x y", 3)], "doc_id long, text string, ids int")
    assert [r.n_tokens for r in bpe.encode(odd, PATH, P.PATTERN, False).collect()] == [0, 0, 2]
    assert bpe.encode(odd.limit(0), PATH, P.PATTERN).count() == 0


def test_words_met_once_make_few_states():
    """A transducer of real size made more than one state for each new word; followed paths give the same ids."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(4, 20))).encode() for _ in range(400)]
    fst = bpe.Transducer(RANKS)
    assert all(fst.encode(w) == bpe.merge(w, RANKS) for w in words)
    assert len(fst.paths) < len(words)
    long = b"".join(words[:60])
    assert fst.encode(long) == bpe.merge(long, RANKS)
