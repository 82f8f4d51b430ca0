"""op12: the sweep against a plain search of all versions, and its SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from lexloom.llm import feature_join as fj
from lexloom.llm.registry import op12_feature_join

VERSIONS = "key string, event long, arrival long, expiry long, id long, note string"


def plain(versions, key, t):
    best = None
    for k, event, arrival, expiry, i, note in versions:
        if None in (k, event, arrival, expiry) or k != key or t is None or not (event <= t and arrival <= t < expiry):
            continue
        rank = (event, -arrival, i is not None, i or 0, note is not None, note or "")
        best = max(best, (rank, (event, -arrival, i, note))) if best else (rank, (event, -arrival, i, note))
    return best and best[1]


def test_sweep_all_times():
    rnd = random.Random(5)
    for n in (0, 1, 7, 70):
        starts = np.array([rnd.randrange(50) for _ in range(n)], np.int64)
        ends = starts + np.array([rnd.randrange(1, 20) for _ in range(n)], np.int64)
        asked = np.arange(-3, 75)
        want = [max((i for i in range(n) if starts[i] <= t < ends[i]), default=-1) for t in asked]
        assert fj.sweep(starts, ends, asked).tolist() == want


@pytest.mark.parametrize(("span", "most"), [(8, 3), (64, 1000), (1, 1), (1000, 2)])
def test_winners_by_brute_force(spark, span, most):
    rnd = random.Random(span)
    pick = lambda n: None if rnd.random() < 0.04 else rnd.randrange(-n, n)
    versions = [(rnd.choice(["a", "a", "a", "b", "", None]), pick(60), pick(60), pick(90), pick(5), rnd.choice(["x", "y", None])) for _ in range(400)]
    versions += versions[:40]  # repeated rows
    asks = [(rnd.choice(["a", "b", "", "none", None]), pick(90), k) for k in range(300)]
    got = fj.point_in_time(spark.createDataFrame(asks, "key string, t long, k long"), spark.createDataFrame(versions, VERSIONS), span, most).collect()
    assert len(got) == len(asks)
    for r in got:
        want = plain(versions, r.key, r.t) if r.key is not None else None
        assert (tuple(r.won) if r.won else None) == want, r
    assert sum(r.won is not None for r in got) > 50


def test_lanes_over_batches(spark):
    """More versions and questions in one lane than an Arrow batch holds."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        versions = [("k", t, t - 1, t + 3 + t % 5, t, "n") for t in range(300)]
        got = fj.winners(spark.createDataFrame(versions, VERSIONS), spark.createDataFrame([("k", t) for t in range(320)], "key string, t long"), 1000, 5000).collect()
        assert {r.t: r.won.id for r in got} == {t: w[2] for t in range(320) if (w := plain(versions, "k", t))}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_and_odd_tables(spark):
    docs = "doc_id long, source string, n_chars long, lang string, key string, won string, at int"
    some = spark.createDataFrame([(1, "s", 3, "en", "x", "y", 1), (None, "s", 4, None, None, None, None), (2, None, None, None, "k", "w", 2)], docs)
    labels = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "doc_id long")
    got = fj.label_features(labels, some).collect()
    assert sorted((r.doc_id or 0, r.t is None) for r in got) == [(0, True), (1, False), (1, False), (2, False), (3, False)]
    assert all(r.status == "none" and r.version_id is None for r in got if r.doc_id != 1)
    assert {r.status for r in fj.label_features(labels, some.where("false")).collect()} == {"none"}
    assert fj.label_features(labels.where("false"), some).count() == 0


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(fj.sql())
    got = op12_feature_join(spark, sf).select(*want.columns).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)
    assert {r.status for r in got} == {"none", "fresh", "stale"}
    one = next(r for r in got if r.doc_id is not None)
    assert one.t == int(hashlib.sha256(str(one.doc_id).encode()).hexdigest()[24:32], 16) % 20000
