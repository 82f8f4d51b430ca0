"""align_terms over all entries, letter by letter, against align_lists."""

from collections import defaultdict

from lexloom.functions.normalize import filing_letter, term
from lexloom.operators.segment import align_lists
from lexloom.plans import QUERIES
from lexloom.plans.lexicon import lexicon

SF = "/root/testdata/sf0.01"


def test_align_terms(spark):
    rows = lexicon(spark, SF).select("index", "term", filing_letter("term").alias("letter"), term("term").alias("norm")).orderBy("index").collect()
    ours, theirs, want = defaultdict(list), defaultdict(list), {r["index"]: (None, 0.0) for r in rows}
    for r in rows:
        ours[r.letter].append(r)
    odd = [(r["index"], r.term + "S" if r["index"] % 5 == 0 else r.term) for r in rows if r["index"] % 7 != 3]
    for r in spark.createDataFrame(odd, "index long, term string").select("term", filing_letter("term").alias("letter"), term("term").alias("norm"), "index").orderBy("index").collect():
        theirs[r.letter].append(r)
    for letter, mine in ours.items():
        for i, j, score in align_lists([r.norm for r in mine], [r.norm for r in theirs[letter]]):
            want[mine[i]["index"]] = (theirs[letter][j].term, score)
    got = {r["index"]: (r.source_headword, r.score) for r in QUERIES["align_terms"](spark, SF).collect()}
    assert got == want and any(s for i, (_, s) in want.items() if i >= 200)
