"""Alignment without a table against the whole table; strings that meet by letters against all pairs."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from lexloom.functions.normalize import term
from lexloom.functions.similarity import score_of
from lexloom.operators import joins as J
from lexloom.operators import segment as G


def spoiled(rnd, words):
    """A copy with terms left out, put in, repeated, misread and swapped."""
    out = []
    for w in words:
        x = rnd.random()
        if x < 0.1:
            continue
        out.append(w + rnd.choice(["", "", "", "S", " LAW", "."]) if x < 0.7 else w[:2] + w[3:] if x < 0.8 else w)
        if x > 0.93:
            out.append(rnd.choice(words))
    if len(out) > 4:
        k = rnd.randrange(len(out) - 3)
        out[k], out[k + 2] = out[k + 2], out[k]
    return out


def terms(rnd, n):
    return sorted("".join(rnd.choice("ABE") for _ in range(rnd.randrange(1, 7))) + rnd.choice(["", "", " OF"]) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_chain_is_the_table(seed):
    rnd = random.Random(seed)
    a = terms(rnd, rnd.randrange(1, 30))
    b = spoiled(rnd, a) if seed % 4 else terms(rnd, 20)
    rnd.random() < 0.2 and rnd.shuffle(b)
    pairs = [(i + 1, j + 1, s) for i, x in enumerate(a) for j, y in enumerate(b) if (s := score_of(x, y)) > 0]
    i, j, s = (np.array(v) for v in zip(*pairs)) if pairs else (np.zeros(0, int),) * 3
    got = [(int(i[p]) - 1, int(j[p]) - 1, float(s[p])) for p in G.heaviest_chain(i, j, np.round(s * 10).astype(int) + 28, len(b))]
    assert got == G.align_lists(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_align_by_the_table(spark, seed):
    """Blocks between anchors, letter by letter."""
    rnd = random.Random(100 + seed)
    a = terms(rnd, 120) + [f"C{x}" for x in terms(rnd, 60)] + ["", "."]
    b = spoiled(rnd, a) if seed else sorted(spoiled(rnd, a))
    frame = lambda t: spark.createDataFrame(list(enumerate(t)), "index long, term string")
    got = {(r["index"], r.source_index, r.score) for r in G.align(frame(a), frame(b)).collect()}
    norm = lambda t: [r.n for r in frame(t).select("index", term("term").alias("n")).orderBy("index").collect()]
    x, y, want = norm(a), norm(b), set()
    letters = lambda t: [r.letter for r in frame(t).select("index", G.filing_letter("term").alias("letter")).orderBy("index").collect()]
    lx, ly = letters(a), letters(b)
    for letter in set(lx):
        p, q = [k for k, l in enumerate(lx) if l == letter], [k for k, l in enumerate(ly) if l == letter]
        want |= {(p[i], q[j], s) for i, j, s in G.align_lists([x[k] for k in p], [y[k] for k in q])}
    assert got == want and len(want) > 50


def test_scored_terms_by_all_pairs(spark):
    rnd = random.Random(3)
    a, b = sorted({*terms(rnd, 70), "A", "AB", "U.S.", "A B C"}), sorted({*terms(rnd, 70), "B", "AC", "US", "A B", "ABE OF LAW AND MORE"})
    got = {(r.a, r.b, r.score) for r in G.scored_terms(spark.createDataFrame([(x,) for x in a], "a string"), spark.createDataFrame([(x,) for x in b], "b string")).collect()}
    assert got == {(x, y, s) for x in a for y in b if (s := score_of(x, y)) > 0}


@pytest.mark.parametrize("least", [0.4, 0.5, 0.7, 0.8, 0.95, 1.0])
def test_letters_lose_no_pair(spark, least):
    rnd = random.Random(int(least * 100))
    words = sorted({"".join(rnd.choice("EETAQ Zé") for _ in range(rnd.randrange(1, 12))) for _ in range(90)})
    frame = lambda x: spark.createDataFrame([(w,) for w in words], f"{x} string")
    got = {(r.a, r.b) for r in J.by_letters(frame("a"), frame("b"), least).collect()}
    assert {(x, y) for x in words for y in words if SequenceMatcher(None, x, y).ratio() >= least} <= got
    assert len(got) < len(words) ** 2
    first = {(r.a, r.b) for r in J.by_letters(frame("a"), frame("b"), least, initial=True).collect()}
    assert first == {(x, y) for x, y in got if x[0] == y[0]}
