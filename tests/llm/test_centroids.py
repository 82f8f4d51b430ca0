"""op11: bounds against measuring all, and the query against plain rounds."""

import hashlib
import math
import random

import numpy as np
import pytest
from lexloom.llm import centroids as cs
from lexloom.llm.registry import op11_centroids
from pyspark.sql import functions as F


def plain(rows, k=8, rounds=10, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) by measuring all distances in whole numbers."""
    kept = [(i, [math.floor(1024 * v) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    tie = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    c = [x for _, x in sorted(kept, key=tie)[:k]]
    apart = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    for _ in range(rounds):
        near = [min(range(len(c)), key=lambda j: (apart(x, c[j]), j)) for _, x in kept]
        for j in range(len(c)):
            if mine := [x for (_, x), a in zip(kept, near) if a == j]:
                c[j] = [sum(v) // len(mine) for v in zip(*mine)]
    near = [min(range(len(c)), key=lambda j: (apart(x, c[j]), j)) for _, x in kept]
    far = [apart(x, c[a]) for (_, x), a in zip(kept, near)]
    each = {j: sum(d for d, a in zip(far, near) if a == j) for j in set(near)}
    return [(i, a, d, each[a], sum(far), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for (i, _), a, d in zip(kept, near, far)]


@pytest.mark.parametrize(("k", "spread"), [(1, 3), (2, 2), (4, 3), (5, 2), (9, 4), (30, 1), (30, 40)])
def test_bounds_equal_measuring_all(k, spread):
    """Few distinct values make very many ties."""
    rnd = np.random.default_rng(k * spread)
    x, c = rnd.integers(-spread, spread, (700, 6)), rnd.integers(-spread, spread, (k, 6))
    state, moves, spared = cs.Bounds.unknown(700, k), np.zeros(k), 0
    for _ in range(8):
        state.moved(moves)
        measured = state.assign(x, c)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (state.near_to == d.argmin(1)).all()
        assert (state.upper >= np.sqrt(d.min(1)) - 1e-6).all()
        spared += 700 * k - measured
        new = np.array([x[state.near_to == j].sum(0) // max(1, (state.near_to == j).sum()) if (state.near_to == j).any() else c[j] for j in range(k)])
        moves, c = np.sqrt(((new - c) ** 2).sum(1)), new
    assert k < 4 or spread < 40 or spared > 700 * k


def test_large_components_are_exact():
    x = np.array([[1 << 24, -(1 << 24)], [(1 << 24) - 1, 5], [0, 0]], np.int64)
    c = x[::-1] - 3
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
    assert cs.squared(x, c).tolist() == want


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_query_by_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op11_centroids(spark, sf).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))


def test_odd_rows(spark):
    rnd = random.Random(1)
    rows = [(i // 2 if i % 9 else None, [rnd.choice([0.0, 0.5, -0.25, 1e-3]) for _ in range(64)]) for i in range(60)]
    rows += rows[:10] + [(100, None), (101, []), (102, [1.0] * 63), (103, [None] + [1.0] * 63), (104, [float("nan")] + [1.0] * 63), (105, [float("-inf")] + [1.0] * 63), (106, [1.0] * 65)]
    got = cs.cluster(frame(spark, rows).withColumn("cluster", F.lit("x")).withColumn("x", F.lit(1))).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows), key=key)


def test_few_and_none(spark):
    two = [(1, [0.0] * 64), (2, [1.0] * 64), (3, [1e30] * 64)]
    got = {r.vec_id: (r.cluster, r.distance) for r in cs.cluster(frame(spark, two)).collect()}
    assert sorted(c for c, _ in got.values()) == [0, 1, 2] and {d for _, d in got.values()} == {0}
    assert cs.cluster(frame(spark, two).where("false")).count() == 0


def test_bounds_spare_distances(spark):
    report = []
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    n = cs.cluster(vectors, report=report).count()
    assert len(report) == 11 and report[0] >= 8 * n and sum(report[1:]) < 0.9 * 80 * n
    print(report, n)
