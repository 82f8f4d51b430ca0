"""Findings of round 4."""

import itertools
import random
import re
from difflib import SequenceMatcher

from lexloom.operators import joins as J
from lexloom.operators import leaves
from lexloom.operators import overlay as O


def test_what_an_explode_makes_is_never_broadcast(spark):
    """Spark takes an exploded side for as small as what it is made from, and built its table in the driver."""
    a, b = (spark.sql(f"select * from values ('BAILIFF'), ('BAIL'), ('A TERM OF MORE LETTERS THAN ARE SHORT') as t({x})") for x in "ab")
    for near in (J.edits_apart(a, b, 2), J.by_letters(a, b, 0.7)):
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert {(r.a, r.b) for r in near.collect()} == {(r.a, r.a) for r in a.collect()} | ({("BAILIFF", "BAIL"), ("BAIL", "BAILIFF")} if near.columns == ["a", "b"] else set())


def page_bodies(terms, pages):
    out = {}
    for k, (t, u) in enumerate(terms):
        for text, upper in pages:
            at = upper.find(u)
            if at >= 0:
                rest = re.sub(r"^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$", "", text[at + len(t) :]).split("\n")
                stop = next((i for i, x in enumerate(rest) if i and len(x.strip(" ")) > 3 and x.strip(" ") == x.strip(" ").upper()), len(rest))
                body = "\n".join(rest[:stop]).strip(" \t\n\v\f\r")
                body = re.sub(r"^[.,;:\-— \t\n\v\f\r]+", "", body).strip(" \t\n\v\f\r")
                out[k] = max(out.get(k, (0, "")), (len(body), body))
    return out


def test_longest_bodies_by_brute_force():
    """terms of a leaf are looked for together; sizes of their bodies need no text of their own."""
    rnd = random.Random(4)
    for letters in ("aB \n.", "abcDE ,\n", "aß—É \n"):
        text = lambda n: "".join(rnd.choice(letters + letters.upper()) for _ in range(n))
        pages = [text(rnd.choice([0, 1, 5, 40, 200, 700])) for _ in range(40)] + ["tail", "tail ABCD\nABCDE\nx", "ABCDEFG\n ABC\t", "THE LAW OF NATIONS is that\n  KINGS \nhold"]
        terms = sorted({p[x : x + n] for p in pages for n in (1, 2, 3, 4, 7, 8, 9, 15, 16, 17, 30) for x in (0, 9)} | {"", "zz", "the law of nations", "THE LAW"})
        terms, pages = [(t, t.upper()) for t in terms], [(p, p.upper()) for p in pages]
        want = page_bodies(terms, pages)
        for least in (0, 20):
            got = leaves.longest_bodies(terms, pages, least)
            assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items() if v[0] > least}
            assert all(want[k][1] in pages[p][0] for k, (_, p) in got.items())


def test_pages_of_a_leaf_in_several_groups(spark, monkeypatch):
    """the longest body and, of equals, the greatest are found across the groups of a leaf; plans shuffle no text for each term."""
    monkeypatch.setattr(leaves, "PAGES", 3)
    rows = [(5, f"page {k}. Bail, a bond that is given in court {k % 7}" + "!" * (k % 4)) for k in range(40)] + [(6, "BAIL one that is alone on its leaf"), (None, "BAIL"), (5, None)]
    pages = spark.createDataFrame(rows, "leaf int, text string")
    e = spark.createDataFrame([(1, "BAIL", "x", ["5"]), (2, "bail", "x", ["5", "6"]), (3, "BAIL", "x", ["7"])], "index long, term string, body string, source_pages array<string>")
    none = spark.createDataFrame([], "term string, body string")
    out = O.near_empty_triage(e, none.select("term"), none, pages, none)
    best = max((len(t.split("Bail, ")[1]), t.split("Bail, ")[1]) for leaf, t in rows if leaf == 5 and t)[1]
    assert {r["index"]: (r.outcome, r.new_body) for r in out.collect()} == {1: ("djvu_recovered", best), 2: ("djvu_recovered", best), 3: ("truncated_body", None)}


def test_pairs_of_rare_letters_are_judged_where_they_meet(spark):
    """1,000 strings with three rare letters in common were a million pairs, each of which had its letters listed."""
    rnd = random.Random(3)
    words = ["AQXZ" + "".join(rnd.choice("BCDFGHKLMNPRSTWEIOUYJV") for _ in range(8)) for _ in range(1000)]
    words += [w[:k] + x + w[k + 1 :] for w in words[:20] for k, x in ((3, "QQ"), (7, ""), (9, "qq9"))] + ["AAAAAAAAAA", "AAAAAAAAAAAA", "A9", "A99", "a99", "AéB—C12345", "AéB-C12345"]
    a, b = (spark.createDataFrame([(w,) for w in sorted(set(words))], f"{x} string") for x in "ab")
    near = J.by_letters(a, b, 0.8, initial=True)
    some = sorted(set(words[-90:]))
    want = {(x, y) for x, y in itertools.product(some, some) if x[0] == y[0] and SequenceMatcher(None, x, y).ratio() >= 0.8}
    assert want <= {(r.a, r.b) for r in near.collect()} and len(want) > len(some)
    rows, todo = [], [near._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.metrics().contains("numOutputRows"):
            rows.append(node.metrics().apply("numOutputRows").value())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())] or ([node.plan()] if node.nodeName().endswith("QueryStage") else [])
    assert rows and max(rows) < 500_000
