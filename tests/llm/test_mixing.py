"""Mixing: targets by repeated resharing, permutations, packing, draws and joins against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from lexloom.llm import mixing
from pyspark.sql import functions as F


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1, "d": 1000, None: 3}, {"x": 5}, {None: 0}, {"a": 100, "b": 100, "é": 100, "z": 7, "Z": 1}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 4096, 5000])
def test_permutation(spark, n):
    df = spark.range(n).select(F.col("id"), mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p"), mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4)).alias("q"))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n)) == sorted(r.q for r in rows)
    if n >= 100:
        assert sum(r.p == r.q for r in rows) < 10 > sum(r.p == r.id for r in rows)


def check_mix(docs, rows):
    """Sizes and targets are exact; of a source as many words are taken as its draws allow around its target."""
    out = mixing.taken(docs).collect()
    assert len(out) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += size(t)
    want = plain_targets(dict(sizes))
    assert Counter((d, size(t), sizes[s]) for d, s, t in rows) == Counter((r.doc_id, r.size, r.source_size) for r in out)
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    by = defaultdict(int)
    for r in out:
        by[r.source_size, round(r.target, 6)] += r.taken
    want_by = Counter()
    for s in sizes:
        want_by[sizes[s], round(want[s], 6)] += want[s]
    for k, v in want_by.items():
        n = sum((sizes[s], round(want[s], 6)) == k for s in sizes)
        # A shard's draw of what whole parts leave has a variance under 1 / 4 for each source with a fraction of 1 / 2.
        shards = sum(sizes.values()) / mixing.BLOCK_WORDS / mixing.SHARD_SLOTS + 1
        assert abs(by[k] - v) <= 48 * n + 32 * 5 * (n * shards) ** 0.5, (k, v, by[k])
    return out


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = check_mix(docs, [(r.doc_id, r.source, r.text) for r in docs.collect()])
    again = mixing.taken(docs.repartition(7)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    places, slots, joined = mixing.mix(docs)
    slots, joined = slots.cache(), joined.cache()
    assert slots.count() == slots.select("shard", "position").distinct().count() == slots.select("source", "pass", "block").distinct().count()
    assert joined.agg(F.sum("words")).first()[0] == sum(r.taken for r in out)
    assert plain_taken(places.collect(), slots.collect()) == Counter((r.doc_id, r.size, r.taken) for r in out)


def plain_taken(places, slots):
    """Word by word: a source's documents in a row by start, and how often the block of each word is taken."""
    times = Counter((s.source, s.block) for s in slots)
    return Counter((p.doc_id, p.size, sum(times[p.source, w // mixing.BLOCK_WORDS] for w in range(p.start, p.start + p.size))) for p in places)


@pytest.mark.parametrize(("slots", "cells"), [(64, 1024), (64, 3), (7, 1), (1540, 5)])
def test_drawn_counts(spark, slots, cells):
    """Every shard is full; counts are the whole parts and a multinomial draw by the fractions, in mean and variance."""
    wanted = {"a": 1000, "b": 500, None: 37, "c": 0, "é": 3}
    quota = spark.createDataFrame([(s, 10_000, q) for s, q in wanted.items()], "source string, n_blocks long, quota long")
    rows = mixing.drawn(quota, 1540, range(3000), slots, 7, cells).groupBy("source", "shard").agg(F.sum("n").alias("n")).collect()
    by, shard = defaultdict(Counter), Counter()
    for r in rows:
        by[r.source][r.n] += 1
        shard[r.shard] += r.n
    assert set(shard.values()) == {slots} and len(shard) == 3000 and "c" not in by
    free = slots - sum(slots * q // 1540 for q in wanted.values())
    for s, q in wanted.items():
        whole, p = slots * q // 1540, (slots * q % 1540) / 1540 / max(1, free)
        mean = sum(n * k for n, k in by[s].items()) / 3000
        true = free * p * (1 - p)
        assert abs(mean - slots * q / 1540) <= 5 * (true / 3000) ** 0.5 + 1e-9
        by[s][0] += 3000 - sum(by[s].values())
        square = sum((n - mean) ** 2 * k for n, k in by[s].items()) / 3000
        assert abs(square - true) <= 0.15 * true + 0.02, (s, square, true)


def test_draws_follow_one_another(spark):
    """first goes on from shard to shard, no source gives more than its passes, and shards close up."""
    quota = spark.createDataFrame([("a", 400, 1000), ("b", 166, 500), (None, 10, 37), ("c", 5, 0), ("é", 1, 3)], "source string, n_blocks long, quota long")
    rows = mixing.draws(quota, 7, 64).collect()
    parts, shards = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.source].append((r.shard, r.first, r.n))
        shards[r.shard].append(r)
    blocks = {"a": 400, "b": 166, None: 10, "é": 1}
    for s, each in parts.items():
        at = 0
        for _, first, n in sorted(each):
            assert first == at
            at += n
        assert at <= 3 * blocks[s]
    assert abs(sum(n for *_, n in parts["a"]) - 1000) < 5 * 25**0.5
    for each in shards.values():
        assert {r.slots for r in each} == {sum(r.n for r in each)}
        assert sorted(r.ahead for r in each) == [sum(x.n for x in each if x.ahead < r.ahead) for r in sorted(each, key=lambda r: r.ahead)]
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.draws(quota, 7, 64).collect()))


def test_draws_decide_what_is_taken(spark, sf, monkeypatch):
    """With the same permutations, other draws take other words; targets are near with all of them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = []
    for slots in (4096, 100, 64):
        monkeypatch.setattr(mixing.draws, "__defaults__", (0, slots, 3))
        monkeypatch.setattr(mixing, "SHARD_SLOTS", slots)
        found.append({r.doc_id: r.taken for r in check_mix(docs, [(r.doc_id, r.source, r.text) for r in docs.collect()])})
    assert all(sum(a[d] != b[d] for d in a) > 5 for a, b in ((found[0], found[1]), (found[1], found[2])))


def test_places_in_the_mix(spark, sf):
    """A document's place is that of a slot which its source has, and sources alternate."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mixed_documents(docs).orderBy("mix_shard", "mix_position", "doc_id").collect()
    slots = {(r.shard, r.position): r.source for r in mixing.mix(docs, block_words=2048)[1].collect()}
    assert out and all(slots[r.mix_shard, r.mix_position] == r.source for r in out)
    assert sum(a.source != b.source for a, b in zip(out, out[1:])) > 20


def test_odd_rows(spark):
    rows = [(1, "a", "x " * 900), (1, "a", "x " * 900), (2, None, "y z"), (None, "b", None), (3, "b", ""), (None, None, "w " * 100), (4, "c", "\x0bq\x0b \x1cr")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, row int")
    check_mix(docs, rows)
    assert mixing.taken(docs.limit(0)).count() == 0
