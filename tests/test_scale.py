"""Findings of the third round: joins that grow with what they find, against plain loops."""

from __future__ import annotations

import itertools
import random

from lexloom.functions import clean as C
from lexloom.functions.similarity import levenshtein
from lexloom.operators import joins as J
from lexloom.operators import overlay as O
from lexloom.operators import segment as G
from pyspark.sql import functions as F


def _words(n: int, letters: str, most: int) -> list[str]:
    rnd = random.Random(n)
    return sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(0, most))) for _ in range(n)})


def test_nearest_as_by_brute_force(spark):
    a, b = _words(120, "abc", 7) + ["x" * 23 + "abc", "y" * 30], _words(90, "abcd", 8) + ["x" * 24 + "ac", "y" * 24, "x" * 25]
    left, right = spark.createDataFrame([(x,) for x in a], "w string"), spark.createDataFrame([(x,) for x in b], "w string")
    near = {(x, y): d for x, y in itertools.product(a, b) if (d := levenshtein(x, y, 2)) <= 2}
    ties = {(x, y, d) for (x, y), d in near.items() if d == min(e for (v, _), e in near.items() if v == x)}
    assert {tuple(r) for r in J.nearest(left, right, "w", 2, every_tie=True).collect()} == ties
    assert {(r.a, r.b, r.distance) for r in J.edits_apart(left.select(F.col("w").alias("a")), right.select(F.col("w").alias("b")), 2).collect()} == {(*k, d) for k, d in near.items()}


def test_nearest_settles_equal_words_first(spark):
    words = spark.createDataFrame([(f"word{k:03d}",) for k in range(300)], "w string")
    got = J.nearest(words, words, "w", 2, every_tie=True).collect()
    assert len(got) == 300 and all(r.a == r.b and r.distance == 0 for r in got)


def test_places_and_substrings_of_any_length(spark):
    rnd = random.Random(7)
    bodies = [(k, "".join(rnd.choice("AB é\n") for _ in range(rnd.randint(0, 300)))) for k in range(60)] + [(60, None), (61, "")]
    patterns = sorted({t[x : x + n] for _, t in bodies if t for n in (1, 2, 3, 7, 8, 9, 20, 31, 32, 33, 60) for x in (0, 11) if t[x : x + n]}) + ["ZZ", "AB" * 40]
    want = {(p, k) for p in patterns for k, t in bodies if t and p in t}
    p, b = spark.createDataFrame([(x,) for x in patterns], "pattern string"), spark.createDataFrame(bodies, "index long, body string")
    assert {(r.pattern, r["index"]) for r in J.substrings(p, b).collect()} == want
    ends = {x: (min(k for q, k in want if q == x), max(k for q, k in want if q == x)) for x, _ in want}
    assert {r.pattern: (r.least, r.greatest) for r in J.places(p, b).collect()} == ends


def test_first_containing_is_the_least_of_containing(spark):
    terms = spark.createDataFrame([(t,) for t in ("the law", "LAW", "O'Neil x", "-", "", "no such")], "term string")
    bodies = spark.createDataFrame([(3, "By the law."), (2, "lawful THE  LAW"), (9, "o'neil, X"), (1, None)], "index long, body string")
    assert {tuple(r) for r in J.containing(terms, bodies).collect()} == {("the law", 3), ("the law", 2), ("LAW", 3), ("LAW", 2), ("O'Neil x", 9)}
    assert {tuple(r) for r in J.first_containing(terms, bodies).collect()} == {("the law", 2), ("LAW", 2), ("O'Neil x", 9)}


def test_running_header_with_a_long_page_number(spark):
    pages = spark.createDataFrame([(12345, ["", "12345  BAIL   BOND  ", "text"]), (2, ["BAIL — BOND  100001"])], "page long, lines array<string>")
    assert {(r.page, r.first_term, r.last_term) for r in G.running_headers(pages).collect()} == {(12345, "BAIL", "BOND"), (2, "BAIL", "BOND")}


def test_body_oracle_without_candidates_shuffles_no_bodies(spark):
    e = spark.createDataFrame([(k, f"T{k}", f"T{k}. " + "x" * 5000) for k in range(400)], "index long, term string, body string").repartition(4)
    out = O.body_oracle(e)
    assert {(r.verdict, r.candidate) for r in out.collect()} == {("skip", None)}
    joined = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull" in joined and "candidate" in joined


def test_near_empty_takes_the_longest_page_of_its_leaf(spark):
    e = spark.createDataFrame([(1, "BAIL", "x", ["5"]), (2, "BAIL", "x", ["6", "q"]), (3, "BAIL", "x", []), (4, "", "x", ["5"])], "index long, term string, body string, source_pages array<string>")
    pages = spark.createDataFrame([(5, "so Bail, a bond that is given in a court."), (5, "BAIL. A bond that is given."), (6, "all of the pages have no such term here"), (7, "BAIL" + " long" * 50)], "leaf int, text string")
    none = spark.createDataFrame([], "term string, body string")
    got = {r["index"]: (r.outcome, r.new_body) for r in O.near_empty_triage(e, none.select("term"), none, pages, none).collect()}
    assert got[1] == ("djvu_recovered", "a bond that is given in a court.") and got[2] == got[3] == ("truncated_body", None)
    assert got[4] == ("djvu_recovered", "so Bail, a bond that is given in a court.")


def test_classify_asks_for_no_ratio_that_no_rule_wants(spark):
    rows = [(1, "BAILIFF", "x" * 50, None, 0.0), (2, "BON", "like this body", None, 0.0), (3, "LONGER", "like this text", "LONGER", 0.95)]
    e = spark.createDataFrame(rows, "index long, term string, body string, source_headword string, confidence double")
    both = spark.createDataFrame([("BON", "like this body.")], "term string, body string")
    dupes = spark.createDataFrame([("BAILIFF", "BAILIFFS", "x" * 50)], "term string, closest string, closest_body string")
    none = spark.createDataFrame([], "term string, kind string, target string")
    got = {r["index"]: (r.entry_type, r.reason) for r in O.classify(e, none, both, dupes, none.select("term")).collect()}
    assert got == {1: ("legacy_duplicate", "ocr_duplicate"), 2: ("fragment_artifact", "in_source"), 3: ("verified_main", "alignment")}


def test_rules_as_spark_applies_them_one_by_one(spark):
    texts = [(1, "tbe @ man 4nd  witb a@ é4nd @b\n a \n i. €. g. v.) ju-\ndge A. 8. a@e"), (2, None), (3, "plain"), (4, "é@ aud  éaud (@ b@n")]
    df = spark.createDataFrame(texts, "index long, body string")
    got = {r["index"]: (r.cleaned, {h.label: h.hits for h in r.rule_hits}) for r in C.with_rules(df, "body", C.EXTENDED_RULES).collect()}
    text = {r["index"]: r.t for r in df.select("index", C.rewritten("body", C.EXTENDED_RULES).alias("t")).collect()}
    assert {k: v[0] for k, v in got.items()} == text and got[2][1] == got[3][1] == {}
    assert got[1][1]["tbe->the"] == 1 and got[1][1]["euro->ie"] == 1
