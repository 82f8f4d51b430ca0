"""SpotSigs against plain Python."""

import hashlib
import re
from collections import Counter
from itertools import combinations

import pytest
from lexloom.llm import spotsigs
from pyspark.sql import functions as F


def bare(word):
    inside = [k for k, c in enumerate(word) if c.isalnum()]
    return word[inside[0] : inside[-1] + 1] if inside else ""


def plain_chains(text, chain=2):
    raw = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [w for w in (bare(w.lower()) for w in raw) if w]
    content, starts = [], {0}
    for w in words:
        if w in spotsigs.ANCHORS:
            starts.add(len(content))
        else:
            content.append(w)
    found = {" ".join(content[k : k + chain]) for k in starts if k < len(content)}
    if len(found) >= spotsigs.FEW and len(found) * spotsigs.SPARSE >= len(words) + 1:
        return found
    words = words or raw
    return {" ".join(words[k : k + chain]) for k in range(len(words))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def want(rows):
    rows = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    out = []
    for k, (d, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        c = plain_chains(t)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(c, plain_chains(edited)), 9), round(jaccard(c, plain_chains(after)), 9), len(c), len(plain_chains(edited))))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), len(r.fingerprint) // 8, len(r.edited_fingerprint) // 8) for r in df.collect())


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_documents(spark, sf, monkeypatch, rows):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", rows)
    monkeypatch.setattr(spotsigs, "STRIDE", 4)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = spotsigs.edited_and_next(docs)
    assert got(out) == want([(r.doc_id, r.text) for r in docs.collect()])
    by = docs.join(out, "doc_id").groupBy("text").agg(F.count_distinct("fingerprint").alias("n")).where("n > 1")
    assert by.count() == 0


def test_odd_rows(spark):
    rows = [(None, "the cat sat"), (1, None), (2, ""), (5, "of the"), (9, "Of  the."), (12, "x " * 40000), (13, "of*** $$the cat, &&&and&&& dog: in-the (house) 12.5 %%% a b"), (14, "*** --- $$$"), (15, "%" * 200000 + " a"), (16, "a" + "%" * 200000 + "b"), (17, " ".join(f"w{k}x" for k in range(300)) + " the")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, bucket int, key string")
    assert got(spotsigs.edited_and_next(docs)) == want(rows)
    assert got(spotsigs.edited_and_next(docs.limit(1))) == want(rows[:1])
    assert spotsigs.edited_and_next(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(4, "a b c"), (4, "a b c"), (3, "d the e")], "doc_id long, text string")
    assert got(spotsigs.edited_and_next(twice)) == want([(4, "a b c"), (4, "a b c"), (3, "d the e")])


def test_all_words_count(spark):
    """Texts without anchors differ in their fingerprints wherever they differ; symbols at anchors do not matter."""
    words = [f"w{k}x" for k in range(200)]
    texts = [" ".join(words), " ".join([*words[:150], "new", *words[151:]]), "der Hund*** und die%%% Katze, &&&mit dem### Ball", "der Hund und die Katze mit dem Ball"]
    got = [r.s for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(spotsigs.signatures(F.col("t")).alias("s")).collect()]
    assert len(got[0]) == 200 and len(set(got[0]) & set(got[1])) == 198 and got[2] == got[3]


def test_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    members, pairs = spotsigs.near_pairs(docs)
    texts = {r.doc_id: plain_chains(r.text) for r in docs.collect()}
    of = {r.doc_id: r["class"] for r in members.collect()}
    sets = {of[d]: c for d, c in texts.items()}
    expect = {(min(a, b), max(a, b)) for a, b in combinations(sets, 2) if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == expect and expect
