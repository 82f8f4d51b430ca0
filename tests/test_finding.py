"""Close terms, substrings and claims against plain loops."""

import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from lexloom.functions.normalize import norm
from lexloom.operators import joins as J
from lexloom.operators import overlay as O
from pyspark.sql import functions as F


def words(rnd, n, letters="ABEST", most=9):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, most))) for _ in range(n)]


@pytest.mark.parametrize(("n", "cutoff"), [(3, 0.7), (10, 0.5), (1, 0.9)])
def test_close_terms_are_difflibs(spark, n, cutoff):
    rnd = random.Random(n)
    wanted, known = sorted({*words(rnd, 40), ""}), sorted({*words(rnd, 60), "", "É"})
    frame = lambda w: spark.createDataFrame([(x,) for x in [*w, *w, None]], "term string")
    got = {r.term: r.close for r in J.close_terms(frame(wanted), frame(known), n, cutoff).collect()}
    assert got == {w: c for w in wanted if w and (c := get_close_matches(w, [k for k in known if k], n, cutoff))}


def test_validate_terms_on_parts(spark):
    """The query over a whole table: no common first letter is asked for."""
    from lexloom.plans import QUERIES

    names = sorted({r.p_name.upper() for r in spark.read.parquet("/root/testdata/sf0.001/part.parquet").select("p_name").collect()})
    got = {r.term: r.close for r in QUERIES["validate_terms"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {f"{w}X": "|".join(get_close_matches(f"{w}X", names, 3, 0.7)) or None for w in names}


@pytest.mark.parametrize("sample", [0, 500])
def test_substrings_by_brute_force(spark, sample):
    rnd = random.Random(sample)
    bodies = [(k, " ".join(words(rnd, rnd.randrange(0, 60), "ABCÉ𝄞", 12))) for k in range(80)] + [(100, ""), (101, None), (102, "AB" * 4000)]
    text = " ".join(b for _, b in bodies if b)
    patterns = [text[at : at + rnd.randrange(1, 20)] for at in (rnd.randrange(len(text)) for _ in range(120))] + ["", None, "ABSENT FROM ALL", "Q", "AB" * 300, "\U0001d11e"]
    got = J.substrings(spark.createDataFrame([(p,) for p in patterns * 2], "pattern string"), spark.createDataFrame(bodies, "index long, body string"), sample=sample).collect()
    want = {(p, k) for p in patterns if p for k, b in bodies if b and p in b}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert J.substrings(spark.createDataFrame([], "pattern string"), spark.createDataFrame(bodies, "index long, body string")).count() == 0


def test_triage_inside_words(spark):
    """A target that stands inside a longer word of another entry is its subentry; in its own body it is not."""
    from lexloom.operators import xref as X

    t = lambda *x: spark.createDataFrame([(v,) for v in x], "term string")
    entries = spark.createDataFrame([(1, "TORT", "of tortfeasors and bail"), (2, "FEASANCE", "feasance only")], "index long, term string, body string")
    got = {r.term: r.reason for r in X.triage(t("FEASOR", "FEASANCE", "BAIL", "NOWHERE"), t("TORT"), t("X"), entries=entries).collect()}
    assert got == {"FEASOR": "subentry", "FEASANCE": "absent", "BAIL": "subentry", "NOWHERE": "absent"}


def plain_claims(rows):
    used, out = set(), set()
    for g, i in sorted({(g, i) for g, i, c, _ in rows if c is not None}):
        best = {}
        for h, k, c, r in rows:
            if (h, k) == (g, i) and c is not None:
                best[c] = min(r, best.get(c, r))
        for _, c in sorted((r, c) for c, r in best.items()):
            if (g, c) not in used:
                used.add((g, c))
                out.add((g, i, c))
                break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_claims_take_turns(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), rnd.randrange(30), rnd.choice([*"uvwxyz", "long", None]), rnd.randrange(3)) for _ in range(120)]
    if seed == 3:  # all ask for the same in the same order
        rows = [("a", k, f"c{j}", j) for k in range(6) for j in range(5)]
    got = {tuple(r) for r in O.greedy_claims(spark.createDataFrame(rows, "g string, index int, choice string, rank int"), "g").collect()}
    assert got == plain_claims(rows)
    assert O.greedy_claims(spark.createDataFrame([], "g string, index int, choice string, rank int"), "g").count() == 0


def plain_misreadings(t):
    out = set()
    for old, new in (*O.MISREAD_RUNS, *O.MISREAD):
        out |= {t[:k] + new + t[k + len(old) :] for k in range(len(t)) if t.startswith(old, k)}
    return sorted(out - {t})


def test_misread_headwords_by_turns(spark):
    rnd = random.Random(4)
    body = "a wrong that is done to one by another for which the law gives damages"
    live = [(w, rnd.choice([body, "another text of its own altogether", None, ""])) for w in sorted(set(words(rnd, 40, "COIL")))]
    open_ = [(k, w, rnd.choice([body, body + " and more", "short", None, "nothing in common 123456789"])) for k, w in enumerate(words(rnd, 70, "COIL") + ["Accoo.", "OOOO", "OOOO", "OOOO"])]
    rows = spark.createDataFrame(open_, "index long, term string, body string")
    normed = {r["index"]: r.n for r in rows.select("index", norm("term").alias("n")).collect()}
    known, taken, want = dict(live), set(), set()
    for k, t, b in open_:
        if len((b or "").strip()) < 20:
            continue
        made = plain_misreadings(normed[k])
        like = lambda x, y: SequenceMatcher(None, x[:2000].lower(), y[:2000].lower()).ratio() if x and y else 0.0
        copy = next((c for c in made if c in known and like(b.strip(), (known[c] or "").strip()) >= 0.4), None)
        if copy:
            want.add((k, t, "legacy_duplicate", copy, round(like(b.strip(), known[copy].strip()), 6)))
            continue
        free = next((c for c in made if c not in known and c not in taken), None)
        if free:
            taken.add(free)
            want.add((k, t, "headword_corrected", free, None))
    got = {(r["index"], r.term, r.entry_type, r.target, r.ratio and round(r.ratio, 6)) for r in O.settle_headwords(rows, spark.createDataFrame(live, "term string, body string")).collect()}
    assert got == want and {x[2] for x in want} == {"legacy_duplicate", "headword_corrected"}
