"""Findings of round 3 on growth: work that went up faster than the input."""

import itertools
import random
from difflib import SequenceMatcher

from lexloom.operators import audit as V
from lexloom.operators import joins as J
from lexloom.operators import segment as G
from pyspark.sql import functions as F


def test_sentences_without_a_head_make_no_rows(spark):
    """A line of many sentences was as many rows, each with all of the line that follows it."""
    line = "BAIL. A thing. " + "It is so.  " * 3000 + "CASE LAW. The end.' BOND. Lat. From x. III. So be it. III. The third."
    got = G.pieces(spark.createDataFrame([(1, line), (2, ""), (3, None)], "i int, text string"), "i").orderBy("i", "piece").collect()
    assert [(r.i, r["head"], r.sound) for r in got] == [(1, "BAIL", True), (1, "CASE LAW", True), (1, "BOND", True), (1, "III", False), (1, "III", True), (2, None, False), (3, None, False)]
    assert [r.piece for r in got[:3]] == [0, 3002, 3004]
    assert " ".join(r.text for r in got[:5]) == line.replace("  ", " ")
    assert [r.text for r in got[1:5]] == ["CASE LAW. The end.'", "BOND. Lat. From x.", "III. So be it.", "III. The third."]


def test_near_duplicates_read_their_entries_once(spark):
    """Entries were read and made anew for every way in which headwords meet."""
    seen = spark.sparkContext.accumulator(0)

    def each(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    entries = spark.createDataFrame([("ANSWERABLE",), ("ANSWERABLES",), ("BAIL BONDSMAN OF THE COURT",), ("BAIL BONDSMEN OF THE COURT",), ("CASE",)], "term string").mapInPandas(each, "term string")
    assert {(r.a, r.b) for r in V.near_duplicates(entries).collect()} == {("ANSWERABLE", "ANSWERABLES"), ("BAIL BONDSMAN OF THE COURT", "BAIL BONDSMEN OF THE COURT")}
    assert seen.value == 5


def test_strings_with_a_common_half_are_not_paired(spark):
    """4,000 strings of twelve characters and 4,000 of thirteen that begin alike were 16 million pairs."""
    a = spark.createDataFrame([(f"THATIS{k:06d}"[: 12 + k % 2],) for k in range(0, 16_000_000, 4001)], "a string").distinct()
    b = a.select(F.concat("a", F.lit("S")).alias("a")).unionByName(a).select(F.col("a").alias("b"))
    got = J.alike(a, b, 0.95)
    assert got.where("length(b) = length(a) + 1 and b = concat(a, 'S')").count() == a.count()
    got.collect()  # metrics of the plan that ran
    rows, todo = [], [got._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.metrics().contains("numOutputRows"):
            rows.append(node.metrics().apply("numOutputRows").value())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())] or ([node.plan()] if node.nodeName().endswith("QueryStage") else [])
    assert rows and max(rows) < 1_000_000


def test_strings_of_one_and_two_edits_by_brute_force(spark):
    rnd = random.Random(8)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.choice([1, 2, 9, 10, 11, 19, 20, 21, 22]))) for _ in range(50)}
    words |= {w[:k] + x + w[k + y :] for w in sorted(words) for k in (0, 4, len(w)) for x, y in (("", 1), ("c", 0), ("c", 1)) if w[:k] + x + w[k + y :]}
    words |= {"x" * n for n in (9, 10, 11, 39, 40, 41, 42)}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "a string")
    for least in (0.8, 0.95):
        want = {(x, y) for x, y in itertools.product(words, words) if 2.0 * min(len(x), len(y)) >= least * (len(x) + len(y)) and SequenceMatcher(None, x, y).ratio() >= least}
        got = {(r.a, r.b) for r in J.alike(df, df.select(F.col("a").alias("b")), least).collect()}
        assert want <= got and len(want) > len(words)
