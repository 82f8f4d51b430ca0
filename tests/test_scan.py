"""Prefix scans against plain loops, over more partitions than groups and the other way round."""

import random

import pytest
from lexloom.operators import scan
from pyspark.sql import functions as F


@pytest.mark.parametrize("seed", range(3))
def test_scans_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["a", "a", "a", "b", None]), rnd.randrange(30), rnd.choice([None, *range(9)])) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, g string, o int, v int")
    rowed = scan.in_order(df, "o", "k")
    last = F.when(F.col("v").isNotNull(), F.struct("_i", "v"))
    got = {r.k: r for r in scan.scanned(rowed, ["g"], total=("sum", F.col("v")), top=("max", F.col("v")), last=("max", last), n=("sum", F.lit(1))).collect()}
    after = {r.k: r.low for r in scan.scanned(rowed, [], before=False, low=("min", F.col("v"))).collect()}
    number = {r.k: r["nth"] for r in scan.numbered(df, "nth", ["o", "k"], ["g"]).collect()}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    assert len(got) == len(rows)
    for at, (k, g, _, _) in enumerate(order):
        own = [r for r in order[:at] if r[1] == g]
        known = [r[3] for r in own if r[3] is not None]
        assert (got[k].total, got[k].top, got[k].n) == (sum(known), max(known, default=None), len(own)), k
        assert (got[k]["last"].v if got[k]["last"] else None) == (known[-1] if known else None)
        assert number[k] == len(own) + 1
        assert after[k] == min((r[3] for r in order[at + 1 :] if r[3] is not None), default=None)


def test_nothing(spark):
    empty = spark.createDataFrame([], "k long, v int")
    assert scan.numbered(empty, "n", ["k"]).count() == 0
