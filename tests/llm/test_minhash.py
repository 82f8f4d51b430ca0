"""op13: signatures against plain permutations, components against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from lexloom.llm import minhash as mh
from lexloom.llm import near_copies
from lexloom.llm.registry import op13_minhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, width=4):
    words = [w.decode("utf-8", "surrogatepass") for w in (text or "").translate(_LOWER).encode("utf-8", "surrogatepass").split()]
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def plain(rows):
    """(doc_id, n, component) by all pairs of distinct sets."""
    sets = [frozenset(plain_set(t)) for _, t in rows]
    up = {s: s for s in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(up, 2):
        if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
            up[root(a)] = root(b)
    least = {}
    for (d, _), s in zip(rows, sets):
        if d is not None:
            least[root(s)] = min(d, least.get(root(s), d))
    return [(d, len(s), least.get(root(s)) if s else d) for (d, _), s in zip(rows, sets)]


def test_signature_is_two_permutations():
    numbers = np.random.default_rng(0).integers(0, 1 << 32, 100_000, dtype=np.uint32)
    assert len(np.unique(mh.permuted(numbers, 5))) == len(np.unique(numbers))
    sigs = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 300)
    first = [int(mh.permuted(np.array([s >> 32 & 0xFFFFFFFF], np.uint32), 13)[0]) for s in sigs.tolist()]
    want = [min(int(mh.permuted(np.array([(x + k) & 0xFFFFFFFF], np.uint32), 14)[0]) for x in first) for k in range(12)]
    assert mh.signature(sigs, 12).tolist() == want
    old, mh.CELLS = mh.CELLS, 64
    assert mh.signature(sigs, 12).tolist() == want
    mh.CELLS = old


def test_share_of_equal_coordinates_is_likeness():
    rnd = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        a = rnd.integers(-(1 << 62), 1 << 62, 500)
        same = int(rnd.integers(0, 500))
        b = np.concatenate([a[:same], rnd.integers(-(1 << 62), 1 << 62, 500 - same)])
        errors.append((mh.signature(a) == mh.signature(b)).mean() - same / (1000 - same))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.04


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_by_all_pairs(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_minhash(spark, f"/root/testdata/{sf}").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(plain(docs))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and not all(r.kept for r in got)


@pytest.mark.parametrize(("stars", "block"), [(2, 1024), (1, 3)])
def test_shared_passage_and_chain(spark, monkeypatch, stars, block):
    """Texts that share most of their words without being alike, some alike, and a chain whose ends are unlike."""
    monkeypatch.setattr(near_copies, "STARS", stars)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rnd = random.Random(9)
    passage = [f"p{k}" for k in range(200)]
    texts = []
    for k in range(40):
        own = [f"o{k // 3}x{j}" for j in range(90)]
        if k % 3:
            own[rnd.randrange(90)] = f"edit{k}"
        texts.append(" ".join(own[:40] + passage + own[40:]))
    words = [f"w{k}" for k in range(120)]
    for step in range(12):
        words = words[:]
        words[10 * step] = f"new{step}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = mh.near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain(rows)
    assert len({r.component_id for r in got}) < 20


def test_odd_rows(spark):
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b c"), (7, "A\tb  C"), (8, "a b c d"), (9, long), (10, long + " end"), (10, long), (None, "a"), (None, "lone words here and there"), (None, "lone words here and there"), (11, "É a b c d"), (12, "é a b c d"), (4, "a"), (13, "a b c d e f"), (14, "a b c d e f")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, n int")
    key = lambda r: tuple((v is not None, v) for v in r)
    got = mh.near_dups(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(plain(rows), key=key)
    assert not any(r.kept for r in got if r.doc_id is None)
    assert mh.near_dups(docs.where("false")).count() == 0
