"""near_dup_ratio against all pairs in plain Python."""

import itertools
from difflib import SequenceMatcher

from lexloom.plans import QUERIES


def test_near_dup_ratio(spark, tmp_path):
    names = ["MAGISTRATES COURT", "magistrate court", "XAGISTRATES COURT", "A" * 45, "A" * 44 + "B", "AB", "AC", "ab", "", None]
    spark.createDataFrame([(n,) for n in names], "p_name string").write.parquet(f"file://{tmp_path}/part.parquet")
    heads = sorted({n.upper() + s for n in names if n is not None for s in ("", "S") if n + s})
    want = {(a, b, round(r, 9)) for a, b in itertools.combinations(heads, 2) if a[0] == b[0] and (r := SequenceMatcher(None, a, b).ratio()) >= 0.95}
    assert {(r.a, r.b, round(r.ratio, 9)) for r in QUERIES["near_dup_ratio"](spark, f"file://{tmp_path}").collect()} == want and len(want) > 5
