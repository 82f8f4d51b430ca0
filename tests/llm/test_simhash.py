"""SimHash against brute force: fingerprints bit by bit, components over all pairs."""

import re

import numpy as np
import pytest
import xxhash
from lexloom.llm import simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    arr = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        near = np.nonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 2)[0]
        for j in near:
            a, b = root(f), root(fps[i + 1 + j])
            up[max(a, b)] = min(a, b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(least.get(root(f), d), d)
    return sorted((d is None, d or 0, f"{f:016x}", least.get(root(f))) for d, f in rows)


def test_masks_cover_every_pair():
    masks = simhash.masks()
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b", "Ab\tCD ef", "x y z w", "É à la la la la", "w " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_components_of_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = simhash.simhash_near_dups(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == want


def test_chains_and_balls(spark):
    rng = np.random.default_rng(7)
    fps = {0}
    for _ in range(25):  # chains of 0 to 3 flips, so that links are often indirect
        f = int(rng.integers(0, 1 << 63))
        for _ in range(30):
            fps.add(f)
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                f ^= 1 << int(b)
    rows = [(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(sorted(fps))]
    got = simhash.components(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = plain_components([(k, f & (1 << 64) - 1) for k, f in rows])
    assert sorted((False, r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got) == want


def test_odd_rows(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (5, None), (6, ""), (None, "q r s t u v w")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component_id int")
    got = simhash.simhash_near_dups(docs).collect()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.simhash_near_dups(docs.limit(0)).count() == 0
