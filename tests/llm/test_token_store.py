"""Words against the whole library, the index on its own, and a store written and read back."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from lexloom.llm import token_store as ts  # noqa: E402

PATH = P.path("word_bpe_49k.json")
THEIRS = tokenizers.Tokenizer.from_file(PATH)
OURS = ts.encoder(PATH)


def ids_of(text):
    return THEIRS.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=50) | st.text(alphabet="aBcİΣσ é́'stLL.,!\n \t\r\x1c\x85<|>19中", max_size=50))
def test_any_text(text):
    assert np.frombuffer(OURS.encode([text])[0], "<u2").tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|> a<|ENDOFTEXT|>.", "it's. the, \n\nI'LL., x.,", "a" * 5000, "word. " * 9000])
def test_hard_text(text):
    assert np.frombuffer(OURS.encode([text])[0], "<u2").tolist() == ids_of(text)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abzéñßİıſǰΐ\u0958\u0301\u1100\u1161中9٣²_", max_size=6), st.text(alphabet="&$%.,'_=>~\"s", max_size=4)), max_size=6))
def test_symbols_at_the_end(parts):
    text = " ".join(a + b for a, b in parts)
    assert np.frombuffer(OURS.encode([text])[0], "<u2").tolist() == ids_of(text)


def test_few_words_remembered(monkeypatch):
    monkeypatch.setattr(ts, "WORDS", 8)
    code, texts = ts.WordEncoder(PATH), [f"word{k % 7} né&&& x{k % 5}%% the, a{k}." for k in range(60)]
    for t in texts:
        assert np.frombuffer(code.encode([t])[0], "<u2").tolist() == ids_of(t)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_index(n):
    rng = np.random.default_rng(n)
    keys, copies = rng.integers(-(2**63), 2**63 - 1, n), rng.integers(0, 3, n)
    records = np.zeros(n, ts.RECORD)
    records["offset"] = np.arange(n)
    index = ts.Index.load(ts.Index.build(keys, copies, records).dump())
    at = index.find(keys, copies)
    assert sorted(at) == list(range(n)) and (index.records["offset"][at] == np.arange(n)).all()
    assert (index.find(rng.integers(-(2**63), 2**63 - 1, 1000), np.zeros(1000, int)) == -1).all()
    assert sum(index.sizes) <= 3.5 * n + 64 * len(index.sizes)
    raw = index.dump()
    part = lambda size, at: raw[at : at + size]
    assert [ts.Index.record(part, k, c)["offset"] for k, c in zip(keys[:200].tolist(), copies[:200].tolist())] == list(range(min(n, 200)))
    assert ts.Index.record(part, 12345, 7) is None


def check(docs, rows):
    rows = sorted(((d, ids_of(t) + [1]) for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    got = sorted(ts.digest(docs, PATH).collect(), key=lambda r: r.start)
    start = 0
    assert len(got) == len(rows)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    order = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=order) == sorted(((d, len(i), crc(i)) for d, i in rows), key=order)


def test_documents(spark, sf, monkeypatch):
    monkeypatch.setattr(ts, "INDEX_KEYS", 50)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_one_id_in_many_shards(spark, tmp_path):
    rows = [(None if k % 3 else k, f"word {k} " * (k % 5)) for k in range(600)] + [(9, "same")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, rows)
    entries = ts.write(docs, PATH, f"file://{tmp_path}/many")
    nulls = entries.where("doc_id is null").collect()
    assert sorted(r.copy for r in nulls) == list(range(400)) and len({r.shard for r in nulls}) > 1


def test_odd_rows(spark, tmp_path):
    rows = [(None, "x"), (None, None), (7, ""), (7, "b c"), (7, "b c"), (-3, "z " * 30000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, shard int, copy int")
    check(docs, rows)
    check(docs.limit(0), [])
    ts.write(docs, PATH, f"file://{tmp_path}/store")
    assert ts.read(spark, f"file://{tmp_path}/store", -3).tolist() == ids_of(rows[5][1]) + [1]
    assert ts.read(spark, f"file://{tmp_path}/store", 7, 2).tolist() == ids_of("b c") + [1]
    assert ts.read(spark, f"file://{tmp_path}/store", 7, 3) is None is ts.read(spark, f"file://{tmp_path}/store", 8)
