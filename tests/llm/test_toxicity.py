"""Noisy-or over sentences, held-out accuracy, location of offending sentences, odd rows."""

import zlib

import numpy as np
import pytest
from lexloom.llm import registry, toxicity


def test_noisy_or_matches_its_sentences():
    model = toxicity.Model({"=bad": 4.0, "ugl": 2.0}, -3.0)
    text = "A bad day. Fine!\n\nUgly, (bad) words? end"
    spans, p = model.sentence_scores(text)
    assert [text[a:b].strip() for a, b in spans] == ["A bad day.", "Fine!", "Ugly, (bad) words?", "end"]
    want = 1 / (1 + np.exp([-1.0, 3.0, -3.0, 3.0]))
    assert np.allclose(p, want) and np.isclose(model.score(text), 1 - np.prod(1 - want))
    assert np.isclose(model.score("so good. so so"), 1 - (1 - 1 / (1 + np.exp(3))) ** 2)
    assert model.score(None) == model.score("") == 0.0


def test_instances_from_bag_labels():
    rng = np.random.default_rng(0)
    plain = [f"w{k}" for k in range(40)]
    texts, labels = [], []
    for k in range(400):
        lines = [" ".join(rng.choice(plain, 6)) + "." for _ in range(5)]
        if k % 4 == 0:
            lines[rng.integers(5)] += " you rotter."
        texts.append("\n".join(lines))
        labels.append(k % 4 == 0)
    model = toxicity.fit(texts, np.array(labels, float))
    spans, p = model.sentence_scores(texts[0])
    assert texts[0][slice(*spans[int(p.argmax())])].strip() == "you rotter." and (np.sort(p)[:-1] < 0.1).all()


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = registry.op3_toxicity(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.03


@pytest.mark.parametrize("labelled", [0, 3])
def test_odd_rows(spark, labelled):
    rows = [(None, None), (1, ""), (1, "bad. " * 50000), (2, "fine")]
    docs = spark.createDataFrame([(*r, 7.0, "k") for r in rows], "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (2, None)][:labelled], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(out) == 4 and out[0].held_out is None and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(docs.limit(0), toxicity.Model({}, 0.0)).count() == 0


def test_query_by_plain_scores(spark, sf):
    """Every score, verdict and number of offending sentences of the query, word by word from the trained weights."""
    import math
    import re

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    outer = ".,;:!?\"'()[]|*#$%&|<>-_"

    def weight(word):
        bare = word.lower().strip(outer)
        return sum(model.weights.get(f, 0.0) for f in (["=" + bare, *(bare[:k] for k in (3, 4, 5, 6, 8) if len(bare) >= k)] if bare else []))

    def plain(text):
        parts = [s for s in re.findall(r"[^.!?\n]+(?:[.!?]+|\n|$)|[.!?\n]+", text or "") if not s.isspace()]
        p = [1 / (1 + math.exp(-max(-50, min(50, model.bias + sum(map(weight, s.split())))))) for s in parts]
        clean = 1.0
        for x in p:
            clean *= 1 - x
        return 1 - clean, sum(x >= 0.3 for x in p)

    got = {r.doc_id: r for r in registry.op3_toxicity(spark, sf).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and model.weights
    for d in rows:
        want, offending = plain(d.text)
        r = got[d.doc_id]
        assert abs(r.score - want) < 1e-6 and (abs(want - 0.3) < 1e-6 or r.predicted == int(want >= 0.3))
        assert r.n_offending == (offending if r.predicted else 0)
