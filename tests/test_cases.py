"""Hand-made cases of single functions and operators, and brute force where SQL has no words."""

import itertools
import json
import random
import re
from difflib import SequenceMatcher, get_close_matches

import pytest
from lexloom.functions import clean as C
from lexloom.functions import normalize as N
from lexloom.functions import similarity as S
from lexloom.operators import audit as V
from lexloom.operators import joins as J
from lexloom.operators import overlay as O
from lexloom.operators import search as Q
from lexloom.operators import segment as G
from lexloom.operators import xref as X
from lexloom.sources import io
from pyspark.sql import functions as F


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize("a, b, want", [("BAIL", "BAIL", 5.0), ("A.B", "AB", 4.5), ("BADGE", "BADGE OF", 3.8), ("", "A", -4.0), ("AB", "AC", 3.0), ("BAILIFF", "BAILIFE", 3.8), ("CAT", "DOG", -4.0)])
def test_score(a, b, want):
    assert S.score_of(a, b) == want


@pytest.mark.parametrize("n, want", [(0, "clean"), (5, "low"), (50, "medium"), (51, "high")])
def test_severity(spark, n, want):
    assert one(spark, N.severity(F.lit(n))) == want


@pytest.mark.parametrize("line, want", [("BACK, adv. To the rear", "BACK"), ("the court.", None), ("CONTRACT. An agreement", "CONTRACT"), ("A. B. C. x", "A"), ("— DASH. x", None), ("WORDS only", None)])
def test_headword(spark, line, want):
    assert one(spark, G.headword(F.lit(line))) == want


@pytest.mark.parametrize("edits, want", [(15, True), (16, False)])
def test_gate(spark, edits, want):
    assert one(spark, C.edit_gate(F.lit("a" * 100), F.lit("b" * edits + "a" * (100 - edits)))) == want


def test_extended_rules(spark):
    df = spark.createDataFrame([("tbe U. 8. aud g. v.)",), ("c@se of 4nd bouse-\nhold i. €.",), (None,), ("",)], "t string")
    rows = C.with_rules(df, "t", C.EXTENDED_RULES).collect()
    assert rows[0].cleaned == "the U. S. and (q. v.)" and {c.label for c in rows[0].rule_hits} == {"tbe->the", "8->S_abbrev", "aud->and", "gv->qv", "qv_paren_fix"}
    assert rows[1].cleaned == "case of and household i. e." and rows[2].cleaned is None and rows[3].cleaned == ""
    assert one(spark, C.rewritten(F.lit("tbe @ busband bolding"), C.EXTENDED_RULES)) == "the a husband holding"


def test_reflow(spark):
    text = F.lit("a judg-\nment by self-\ndefense\nand so\n1. one\n\nnext  para")
    assert one(spark, C.reflow(text)) == "a judgment by self-defense and so\n1. one\n\nnext para"
    assert one(spark, C.reflow(text, as_coded=True)).startswith("a judg ment by self defense")


@pytest.mark.parametrize("q, want", [("mort", [("MORT", 100), ("MORTGAGE", 80), ("A MORTGAGE", 60), ("OTHER", 20)]), ("  ", []), ("zzz", [])])
def test_search(spark, q, want):
    rows = [(0, "MORTGAGE", ""), (1, "A MORTGAGE", ""), (2, "MORT", ""), (3, "OTHER", "a mort thing"), (4, "NONE", "x")]
    assert [(r.term, r.score) for r in Q.ranked(spark.createDataFrame(rows, "index long, term string, body string"), q).collect()] == want


def test_xrefs(spark):
    heads = spark.createDataFrame([("FRAUD",), ("WRIT",), ("ERROR",)], "term string")
    refs = spark.createDataFrame([(1, "FRAUD UPON US"), (2, "NO HEAD"), (3, "")], "ref_id long, raw string")
    assert [(r.ref_id, r.target, r.rest) for r in J.longest_prefix(refs, heads, "raw", X.STOP).collect()] == [(1, "FRAUD", "UPON US")]
    refs = spark.createDataFrame([(1, "the writ of error")], "ref_id long, raw string")
    assert [r.target for r in J.longest_phrase(refs, heads, "raw", X.STOP).collect()] == ["ERROR"]
    assert [r.target for r in J.longest_phrase(refs, heads, "raw", X.STOP, right_first=False).collect()] == ["WRIT"]


def test_shard_letters(spark):
    got = [r.letter for r in io.lettered(spark.createDataFrame([("",), ("Ælf",), ("(X",), ("abc",)], "term string")).collect()]
    assert got == ["A", "Æ", "(", "A"] and one(spark, N.leaf_to_page(F.array(F.lit(11), F.lit(12), F.lit(22)))) == [1, 11]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_nearest_is_complete(spark, most):
    words = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ab", repeat=n)] + ["abcdefgh", "abcdxfgh", "bcdefgh", "abcdefghij", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    want = {(a, b) for a, b in itertools.combinations(sorted(words), 2) if S.levenshtein(a, b, most) <= most}
    assert {(r.a, r.b) for r in J.within(df, "w", most).collect()} == want


def test_near_duplicates(spark):
    words = ["MAGISTRATES COURT", "MAGISTRATE COURT", "MAGISTRATES COURTS OF THE REALM", "MAGISTRATE COURTS OF THE REALM", "XAGISTRATES COURT", "A" * 45, "A" * 44 + "B", "AB", "AC"]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    want = {(a, b) for a, b in itertools.combinations(sorted(words), 2) if a[0] == b[0] and SequenceMatcher(None, a, b).ratio() >= 0.95}
    assert {(r.a, r.b) for r in V.near_duplicates(df).collect()} == want and len(want) >= 2


def test_alike_misses_nothing(spark):
    """All pairs of a ratio are among the candidates, for short, long, repetitive and edited strings."""
    rng, words = random.Random(3), []
    for n in (1, 3, 9, 10, 11, 19, 20, 21, 39, 60, 76, 79, 80, 81, 84, 120, 200):
        for letters in ("AB", "ABCDEFGHIJKLMNOPQRSTUVWXYZ "):
            base = "".join(rng.choice(letters) for _ in range(n))
            words.append(base)
            for edits in (1, 2, n // 20, n // 12):
                x = list(base)
                for _ in range(edits):
                    at = rng.randrange(len(x) + 1)
                    x[at : at + rng.choice((0, 1))] = rng.choice(("", rng.choice(letters)))
                words.append("".join(x))
    words = sorted({w for w in words if w})
    one, two = (spark.createDataFrame([(w,) for w in words], f"{x} string") for x in "ab")
    for least in (0.95, 0.92):
        want = {(a, b) for a in words for b in words if SequenceMatcher(None, a, b).real_quick_ratio() >= least and SequenceMatcher(None, a, b).ratio() >= least}
        got = {(r.a, r.b) for r in J.alike(one, two, least).collect()}
        assert not want - got and len(want) > 2 * len(words) - 20


def test_neighbours(spark):
    rows = [("x" if k % 5 else "y", k * 37 % 101, k if k % 3 == 0 else None) for k in range(100)] + [("z", 1, None)]
    got = {(r.g, r.o): (r.before, r.after) for r in J.neighbours(spark.createDataFrame(rows, "g string, o long, v long"), ["o"], "v", "g").collect()}
    for g, o, _ in rows:
        known = sorted((p, v) for h, p, v in rows if h == g and v is not None)
        assert got[g, o] == (next((v for p, v in known[::-1] if p < o), None), next((v for p, v in known if p > o), None))


def test_containing(spark):
    terms = ["A", "A B", "A B C", "A B C D", "B C D E F", "Z", "A-B", "  "]
    bodies = [(1, "x a b c d e"), (2, "b c d e f"), (3, "za b"), (4, ""), (5, "a b! c, d"), (6, "a b c e")]
    flat = lambda t: " " + " ".join(re.findall("[A-Z0-9]+", t.upper())) + " "
    want = {(t, k) for t in terms for k, b in bodies if flat(t).strip() and flat(t) in flat(b)}
    got = J.containing(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(bodies, "index long, body string")).collect()
    assert {(r.term, r["index"]) for r in got} == want and len(got) == len(want) > 8


def test_line_start(spark):
    terms = ["THE", "THE CAT", "THE CAT SAT", "A-B", "DOG"]
    lines = [(1, "The cat. x"), (2, "the. y"), (3, "  THE CAT SAT, on"), (4, "a-b. z"), (5, "dogs. no"), (6, "the cat sat. on"), (7, "The cats. no")]
    got = {r.term: r.pages for r in J.line_start(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(lines, "page int, line string")).collect()}
    assert got == {"THE": [2], "THE CAT": [1], "THE CAT SAT": [3, 6], "A-B": [4]}


@pytest.mark.parametrize("old, new, want", [("the shew of", "the show of", True), ("shew it", "shew them", False), ("Nisi  Prius", "x", True), ("tbe", "the", False), (None, None, False), ("gaol", "GAOL", False)])
def test_archaic(spark, old, new, want):
    assert one(spark, C.archaic(F.lit(old).cast("string"), F.lit(new).cast("string"))) is want


def test_swapped_words_and_garbled(spark):
    assert len(C.MISREAD) == 43 and dict(C.MISREAD)["busband"] == "husband" and len({a for a, _ in C.MISREAD}) == 43
    rows = {"n.\nfrom. x y z": True, "n. from. x y z": True, ". a body here": True, ", a body here": True, "short": True, "a whole body here": False, None: True}
    got = spark.createDataFrame([(b,) for b in rows], "b string").select("b", C.garbled_rebuilt("b").alias("g")).collect()
    assert {r.b: r.g for r in got} == rows


def test_court_cites(spark):
    pattern = re.compile(r"([A-Z][a-z]+(?:.+?)?)\s+v\.\s+[A-Z]", re.IGNORECASE)
    texts = ["Smith v. Jones", "Doe and others v. Roe and others v. Poe", "1 v. Jones", "Smith\nv. Jones", "ab\n1 v. Jones", "x v. y", "He v. V. v. W", "", "Smith v Jones", "A. B. v. C", "long " * 2000 + "v. x", "the man v.  Q and v. r\nbut so v. s"]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(V.court_cites(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [len(pattern.findall(t)) for t in texts]


def plain_segments(lines, known):
    """The state machine of entries in plain words: lines are (page, text)."""
    out, blank = [], True
    for page, line in lines:
        if not line.strip():
            if out and out[-1][2][-1] != "":
                out[-1][2].append("")
            blank = True
            continue
        parts = re.split(r"(?:(?<=[.!?;:])|(?<=[.!?;:][\"')\]]))\s+(?=[A-Z])", line)
        for k, text in enumerate(parts):
            after = " ".join(parts[k:])
            m = re.match(G.HEADWORD, after)
            head = re.sub(r"[.,;:]+$", "", " ".join(m[1].split())) if m and not re.match(r"\s*[—'\"a-z-]", after) else None
            sound = bool(head)
            if head and (len(head.replace(" ", "")) <= 2 or re.fullmatch(r"\d+|[IVXLCDM]+", head.replace(" ", ""))):
                rest = re.sub(r"^\s*[.,:;]?", "", after.lstrip()[len(head) :])
                sound = bool(re.match(r"\s*(An?|The|In|To|Of|Lat\.|Fr\.|n\.|v\.|adj\.)\s", rest))
            if k and not (head in known and sound):
                if out:
                    out[-1][2][-1] += " " + text
                continue
            cur = out[-1][0] if out else None
            merge = bool(cur and head and (head == cur or (head not in known and head[0] == cur[0] and S.levenshtein(head, cur, 1) <= 1)))
            extend = bool(cur and head and head not in known and head.startswith(cur + " "))
            start = bool(head and sound and not merge and (head in known or (blank and k == 0 and not extend)))
            if start:
                out.append((head, head, [text], [page]))
            elif out:
                out[-1][2].append(text)
                if out[-1][3][-1] != page:
                    out[-1][3].append(page)
            blank = cur is None and not start
    return [(h, "\n".join(b).strip("\n"), p) for _, h, b, p in out]


def test_segments(spark):
    known = ["BACK", "BAIL", "BADGE", "CONTRACT", "A", "IV", "BAIT"]
    lines = [
        (1, "preface text"), (1, "BACK. To the rear"), (1, "and on. BAIL. A thing given. Other Words. X"), (1, "BAOK, adv. again"), (1, ""), (1, "BADGE, n. A mark"), (2, "BADGE OF FRAUD. Inside"), (2, ""),
        (2, "BADGE OF FRAUD. Still inside"), (2, ""), (2, "NEWWORD. After a blank"), (2, "NOTKNOWN. Without one"), (3, "BAIL. Known"), (3, "BAIT. Known and one edit from it"), (3, ""), (3, ""), (3, "IV. 2 Black. Com."), (3, "A. The first letter. CONTRACT. An agreement"),
        (4, "III. The third"), (4, "BAIL. x. BAIL. y"), (4, ""),
    ]
    rows = [(v, p, i, t) for v in (1, 2) for i, (p, t) in enumerate(lines[v - 1 :])]
    heads = spark.createDataFrame([(h,) for h in known], "term string")
    got = G.segment(spark.createDataFrame(rows, "vol int, page int, pos int, text string"), "vol", "page", "pos", heads).orderBy("vol", "source_index").collect()
    for v in (1, 2):
        assert [(r.source_headword, r.body, r.pages) for r in got if r.vol == v] == plain_segments(lines[v - 1 :], known)
    first = [r.source_headword for r in got if r.vol == 1]
    assert first == ["BACK", "BAIL", "BADGE", "NEWWORD", "BAIL", "BAIT", "A", "CONTRACT", "BAIL"]


def test_headword_duplicates(spark):
    text = "the money that a person pays to be let out of prison until the day of the trial comes"
    verified = [("CONTRACT", text + " contract"), ("CONTRACTS", text), ("BAILIFFS", text + " x"), ("OCCUPANT", "some other thing"), ("CASE", text)]
    opened = [(1, "OONTRACT", text + " contraot"), (2, "BAILIFFE", text), (3, "BAILIFFE", "unlike"), (4, "OCOUPANT", text), (5, "OASE", text), (6, "CONTRACTE", text), (7, "CAT", text), (8, "OONTRACTE", text), (9, "LONG WORDS HERE", None)]
    got = {(r["index"], r.term, r.corrected, r.strategy, round(r.body_sim, 6)) for r in O.headword_duplicates(spark.createDataFrame(opened, "index long, term string, body string"), spark.createDataFrame(verified, "term string, body string")).collect()}
    key = lambda b: " ".join((b or "").split()).upper()
    like = lambda a, b: SequenceMatcher(None, a, b).ratio()
    want = set()
    for k, t, body in opened:
        changed = {"".join(p) for p in itertools.product(*((c, "C") if c == "O" else (c,) for c in t)) if 0 < sum(x != y for x, y in zip(p, t)) <= 2}
        hits = sorted((v, like(key(body), key(b))) for v, b in verified if v in changed and len(t) >= 4 and body and like(key(body), key(b)) >= 0.8)
        if hits:
            want.add((k, t, hits[0][0], "oc_dup", round(hits[0][1], 6)))
            continue
        near = [(-(0.3 * like(t, v) + 0.7 * like(key(body), key(b))), v, like(key(body), key(b))) for v, b in verified if len(t) >= 5 and abs(len(t) - len(v)) <= 2 and (t[0] == v[0] or (t[0], v[0]) == ("O", "C")) and like(t, v) >= 0.92 and body and like(key(body), key(b)) >= 0.8]
        if near:
            want.add((k, t, min(near)[1], "fuzzy_dup", round(min(near)[2], 6)))
    assert got == want and {s for *_, s, _ in want} == {"oc_dup", "fuzzy_dup"}


def plain_alignment(a, b):
    best = {}

    def go(i, j):
        if (i, j) not in best:
            options = []
            if i and j:
                s, path = go(i - 1, j - 1)
                m = S.score_of(a[i - 1], b[j - 1])
                options.append((s + m, [*path, (i - 1, j - 1, m)]))
            if i:
                s, path = go(i - 1, j)
                options.append((s - 2.0, path))
            if j:
                s, path = go(i, j - 1)
                options.append((s - 0.8, path))
            best[i, j] = max(options, key=lambda o: o[0]) if options else (0.0, [])
        return best[i, j]

    return [m for m in go(len(a), len(b))[1] if m[2] > 0]


def test_alignment(spark):
    a, b = ["BACK", "BAIL", "BAILIFF", "BALANCE", "BAN"], ["BACK.", "BADGE", "BAILIFE", "BALANCE SHEET", "BAND", "BAR"]
    assert G.align_lists(a, b) == plain_alignment(a, b)
    frame = lambda t: spark.createDataFrame(list(enumerate(t)), "index long, term string")
    got = {(r[0], r.source_index, r.score) for r in G.align(frame(a), frame(b)).collect()}
    assert got == {(i, j, s) for i, j, s in plain_alignment(a, [x.rstrip(".") for x in b])}



def test_overlay(spark):
    rows = [(0, "BAIL", "Bail is", "BAIL", 0.95), (1, "U. S.", "x", None, 0.0), (2, "XIV", "x", None, 0.0), (3, "MANOR", "MANOR a great house of land", None, 0.0), (4, "ALIAS", "x", None, 0.0), (5, "TORTS", "a wrong done to one", None, 0.0), (6, "KEPT", "x", "KEPT", 0.75)]
    e = spark.createDataFrame(rows, "index long, term string, body string, source_headword string, confidence double")
    manual = spark.createDataFrame([("ALIAS", "alias_variant", "T"), ("KEPT", "unmatched_keep", None)], "term string, kind string, target string")
    cand = spark.createDataFrame([("MANOR", "MANOR a house")], "term string, body string")
    dupes = spark.createDataFrame([("TORTS", "TORT", "a wrong done to one")], "term string, closest string, closest_body string")
    got = {r.term: (r.entry_type, r.canonical_target) for r in O.classify(e, manual, cand, dupes, spark.createDataFrame([], "term string")).collect()}
    assert got == {"BAIL": ("verified_main", None), "U. S.": ("appendix_abbrev", None), "XIV": ("junk_headword", None), "MANOR": ("recovered_main", None), "ALIAS": ("alias_variant", "T"), "TORTS": ("legacy_duplicate", "TORT"), "KEPT": ("provisional_main", None)}


def test_claims_and_oracle(spark):
    o = spark.createDataFrame([("A", 1, "X", 0), ("A", 2, "X", 0), ("A", 2, "Y", 1), ("A", 3, "Y", 0)], "letter string, index long, choice string, rank int")
    assert sorted((r["index"], r.choice) for r in O.greedy_claims(o, "letter").collect()) == [(1, "X"), (2, "Y")]
    e = spark.createDataFrame([(0, "OASE", "CASE. A thing"), (1, "BAIL", "BAIL. x"), (2, "BALL", "BAIL. x")], "index long, term string, body string")
    assert {r.term: r.verdict for r in O.body_oracle(e).collect()} == {"OASE": "correct", "BAIL": "skip", "BALL": "suppress"}


def test_repair(spark):
    e = spark.createDataFrame([(k, "T", f"b{k}") for k in range(5)], "index long, term string, body string")
    assert sorted(r.fixed for r in O.repair(e, lambda bodies: [b.upper() for b in bodies], 2).collect()) == [f"B{k}" for k in range(5)]


def test_sources(spark, tmp_path):
    page = '<DjVuXML><BODY>{}</BODY></DjVuXML>'
    obj = '<OBJECT width="100" height="200"><HIDDENTEXT><PAGECOLUMN><REGION><PARAGRAPH><LINE><WORD coords="1,9,5,2">The</WORD><WORD coords="6,2,9,8">law ,</WORD><WORD coords="x">no</WORD></LINE></PARAGRAPH></REGION></PAGECOLUMN></HIDDENTEXT></OBJECT>'
    (tmp_path / "v.xml").write_text(page.format(obj * 2))
    rows = io.page_xml(spark, f"file://{tmp_path}/v.xml").orderBy("leaf").collect()
    assert [(r.leaf, r.text, r.x0, r.y0, r.x1, r.y1) for r in rows] == [(1, "The law,", 1, 2, 9, 9), (2, "The law,", 1, 2, 9, 9)]
    (tmp_path / "m.xml").write_text('<book><page leafNum="3"><pageNumber> 7 </pageNumber><pageType></pageType></page><page leafNum="x"/></book>')
    assert [tuple(r) for r in io.page_metadata(spark, f"file://{tmp_path}/m.xml").collect()] == [(3, "7", None)]
    (tmp_path / "a.json").write_text(json.dumps([{"term": "A", "body": "x", "source_pages": ["1"]}]))
    (tmp_path / "l.jsonl").write_text('{"term": "A", "body": "x"}\n\n{broken\n{"term": "B"}\n')
    (tmp_path / "c.csv").write_text('term,definition\nA,"one ""q""\ntwo"\n,none\n')
    (tmp_path / "k.json").write_text(json.dumps({"term": {"0": "A", "1": "B"}, "definition": {"0": "x", "1": "y"}}))
    (tmp_path / "r.md").write_text("# t\n## One\nx\n## Two\ny\n")
    at = f"file://{tmp_path}"
    assert io.json_array(spark, f"{at}/a.json").count() == 1
    assert sorted(r.term for r in io.json_lines(spark, f"{at}/l.jsonl", "term string, body string").collect() if r.term) == ["A", "B"]
    assert [tuple(r) for r in io.csv_corpus(spark, f"{at}/c.csv").collect()] == [("A", 'one "q"\ntwo')]
    assert sorted(tuple(r) for r in io.column_json(spark, f"{at}/k.json").collect()) == [("A", "x"), ("B", "y")]
    assert [r.title for r in io.report_sections(spark, f"{at}/r.md").collect()] == ["One", "Two"]
    entries = spark.createDataFrame([("Ab", "x", ["1"]), ("", "y", None), ("(", "z", None)], io.ENTRY)
    assert sorted((r.letter, r["count"]) for r in io.write_shards(entries, f"{at}/store").collect()) == [("A", 2)]
    assert io.read_shards(spark, f"{at}/store", "A").count() == 2 and spark.read.json(f"{at}/store/rejects").count() == 1
    io.write_alignment_csv(spark.createDataFrame([("A", 1.0, ["1", "2"])], "term string, score double, pages array<string>"), f"{at}/csv")
    assert spark.read.csv(f"{at}/csv", header=True).first().asDict() == {"term": "A", "score": "1.00", "pages": "1, 2"}


def test_stream(spark, tmp_path):
    from lexloom.streaming import ingest

    (tmp_path / "in").mkdir()
    rows = [{"term": "Bail", "body": "x", "seen_at": "2024-01-01T00:00:00Z"}, {"term": "BAIL", "body": "x", "seen_at": "2024-01-01T01:00:00Z"}, {"term": "cat", "body": "y", "seen_at": "2024-01-01T01:00:00Z"}]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    s = ingest.fresh(ingest.watch(spark, f"file://{tmp_path}/in", "term string, body string, seen_at timestamp"))
    ingest.into_shards(s, f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    got = spark.read.json(f"file://{tmp_path}/out/*/*")
    assert got.count() == 2


def test_exact_forms(spark):
    df = spark.createDataFrame([("ﬁ“x” é–",), (None,)], "t string")
    assert [r[0] for r in df.select(N.chars_exact("t")).collect()] == ['fi"x" é-', None]
    assert [r[0] for r in df.select(N.unmarked_exact("t")).collect()] == ["fi“x” e–", None]
    assert one(spark, N.term(F.lit(" Café  au lait.;"))) == "CAFE AU LAIT" and one(spark, N.header_term(F.lit("[“æther.]"))) in ("“AETHER", "AETHER")


def test_boundaries_and_gaps(spark):
    body = "BAIL is a security given for the appearance of one\n\nBALL. A round thing that one throws at others\n\nBAIL BOND. A bond of it that is given to court\n\nZEBRA. An"
    e = spark.createDataFrame([(1, "BAIL", body), (2, "BAKER", "A baker of bread and of other things\n\nBALL. A round thing that one throws at others")], "index long, term string, body string")
    got = {(r["index"], r.head): r.action for r in O.boundary_decisions(e, spark.createDataFrame([("ZEBRA",)], "term string")).collect()}
    assert got == {(1, "BALL"): "extract", (1, "BAIL BOND"): "reject", (1, "ZEBRA"): "reject", (2, "BALL"): "reject"}
    t = lambda *x: spark.createDataFrame([(w,) for w in x], "term string")
    h = spark.createDataFrame([("BAIL", "BALX"), ("TRUST", "12")], "first_term string, last_term string")
    b = spark.createDataFrame([(1, "a trust, held")], "index long, body string")
    assert {r.term: r.kind for r in O.header_gaps(h, t("BAIL"), t("BALL"), b, 1).collect()} == {"BAIL": "exact", "BALX": "fuzzy", "TRUST": "subentry", "12": "noise"}
    assert {r.term: r.close for r in O.validate_terms(t("bail", "balx", "zzz"), t("BAIL", "BALL")).collect()} == {"BALX": get_close_matches("BALX", ["BAIL", "BALL"]), "ZZZ": None}
