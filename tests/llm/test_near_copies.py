"""Near copies of the pipeline against all pairs in plain Python."""

from itertools import combinations

import corpus_pipeline as pipeline
import pytest
from lexloom.llm import near_copies, simhash

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_sets(text):
    words = (text or "").lower().split()
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    up = {d: d for d, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    facts = {d: (simhash.fingerprint(t) & (1 << 64) - 1, plain_sets(t)) for d, t in rows}
    for a, b in combinations(up, 2):
        (fa, sa), (fb, sb) = facts[a], facts[b]
        if (fa ^ fb).bit_count() <= 2 or (len(sa) >= 0.8 * len(sb) and len(sb) >= 0.8 * len(sa) and 5 * len(sa & sb) >= 4 * len(sa | sb) > 0):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return sorted({root(d) for d in up})


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_kept([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in pipeline.drop_near_copies(spark, docs, SF).collect()) == want
    assert len(want) < simhash.keep_first(docs).count()


@pytest.mark.parametrize("often", [0, 10**6])
def test_chain_and_common_line(spark, monkeypatch, often):
    """A chain of edits whose ends are unlike, and texts that share only a line; the order of shingles changes nothing."""
    monkeypatch.setattr(near_copies, "OFTEN", often)
    words = [f"w{k}" for k in range(120)]
    texts = []
    for step in range(12):
        words = words[:]
        words[10 * step] = f"new{step}"
        texts.append(" ".join(words))
    line = "one line that very many of the pages here have at their end"
    texts += [" ".join(f"x{k}y{j}" for j in range(30)) + " " + line for k in range(20)] + ["", None, "a b", "A  b"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], SCHEMA)
    got = sorted(r.doc_id for r in near_copies.keep_first(docs).collect())
    assert got == plain_kept(list(enumerate(texts))) and [d for d in got if d < 12] == [0]
