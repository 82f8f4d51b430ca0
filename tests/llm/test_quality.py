"""Base statistics against plain Python, monotonic trees, held-out accuracy."""

import re
from collections import Counter

import numpy as np
import pytest
from lexloom.llm import quality, registry


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), dup, len(hit)]


@pytest.mark.parametrize("text", [None, "", " \n ", "a", "a b c d e", "a b c d e a b c d e", "é#x | y\né#x | y\n \n ", "x " * 3000, "\x1cq \x85 r\n\x1cq \x85 r"])
def test_base(text):
    assert quality.statistics(text)[0] == plain_base(text)


def test_documents(spark, sf):
    rows = {r.doc_id: r for r in registry.op7_quality(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, base = rows[d.doc_id], plain_base(d.text)
        assert [r[c] for c in quality.BASE] == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.base_failed and r.kept)


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model).collect()
    good, bad = [r for r in rows if r.quality == 1 and not r.base_failed], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(r.kept for r in bad) <= 0.2 * len(bad)


def test_monotone():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + rng.normal(size=3000) > 0).astype(float)
    model = quality.fit(x, y, np.array([1, -1, 0]))
    probe = np.repeat(rng.normal(size=(50, 3)), 40, axis=0)
    for j, way in ((0, 1), (1, -1)):
        moved = probe.copy()
        moved[:, j] = np.tile(np.linspace(-3, 3, 40), 50)
        steps = np.diff(model.score(moved).reshape(50, 40), axis=1)
        assert (way * steps >= -1e-12).all()
    assert ((model.score(x) > 0.5) == y).mean() > 0.7


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, "w " * 90000), (2, "a b c d e f g h i j k")]
    docs = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, score int, kept string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (1, 0)], "doc_id long, quality int")
    out = quality.score(docs, quality.train(docs, labels)).collect()
    assert [r.n_words for r in out] == [0, 0, 90000, 11] and [r.base_failed for r in out] == [True, True, True, False]
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0


def test_verdict_by_plain_trees(spark, sf):
    """The query's score and verdict of every document, node by node from the trained trees."""
    import math

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))

    def value(x, t, node=0):
        inner = model.feature.shape[1]
        if node >= inner:
            return model.value[t, node - inner]
        return value(x, t, 2 * node + (1 if x[model.feature[t, node]] <= model.cut[t, node] else 2))

    got = {r.doc_id: r for r in registry.op7_quality(spark, sf).collect()}
    for d in docs.collect():
        base, x = quality.statistics(d.text)
        p = 1 / (1 + math.exp(-(model.base + sum(value(x, t) for t in range(len(model.feature))))))
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert abs(got[d.doc_id].score - p) < 1e-9 and got[d.doc_id].kept == (not failed and p >= quality.THRESHOLD)
