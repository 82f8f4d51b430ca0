"""Point-in-time feature join by an active-rank bitset sweep (operator 12).

A version of a key is usable at time t if event <= t and arrival <= t < expiry, so from the later of event and arrival
on until its expiry. The latest event wins, then the earliest arrival, then the largest id.

1. Versions that are equal in key and times are one, that of the largest id (combined before the shuffle).
2. A version goes to each chunk of ``span`` time units that it is usable in, a question (key, t) to the chunk of its t.
   Chunks without questions are left out. A chunk with more than ``most`` versions is dealt by hash to several lanes, each of
   which answers all of the chunk's questions; as questions are distinct there are at most ``span`` of them in a lane.
3. Each lane is sorted by winning order, so that a version's rank is its place. The sweep goes through the times, toggles a
   version's bit at its start and at its expiry, and the highest bit set at t is the winner.
4. The best of a question's lanes is a maximum, combined before the shuffle; labels get it by an equality join.

No step depends on how many rows a key has: lanes are bounded by ``most``, and nothing goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN, MOST = 256, 4096
#: Of the query: how old a fresh version may be, and the number of seconds that times lie in.
FRESH, SECONDS = 60, 20_000


def sweep(starts: np.ndarray, ends: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """For each of the ascending times asked the highest i with starts[i] <= time < ends[i]; -1 if there is none."""
    n = len(starts)
    times, ranks = np.concatenate([starts, ends]), np.tile(np.arange(n), 2)
    order = np.argsort(times, kind="stable")
    # How many toggles come up to each question; a version that starts and ends in between cancels out.
    upto = np.searchsorted(times[order], asked, side="right")
    ranks, active, done, out = ranks[order].tolist(), 0, 0, []
    for k in upto.tolist():
        for r in ranks[done:k]:
            active ^= 1 << r
        done = k
        out.append(active.bit_length() - 1)
    return np.array(out, np.int64)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Winners of sorted lanes: rows key, chunk, lane, ask, at, until, won; a lane's versions come before its questions."""
    kept: list[pa.RecordBatch] = []  # of the lane that is not known to be over

    def swept(rows: pa.Table, ends: list[int]) -> pa.RecordBatch:
        ask, at, until = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("ask", "at", "until"))
        asked, found, low = [], [], 0
        for high in ends:
            middle = low + int(np.searchsorted(ask[low:high], True))
            got = sweep(at[low:middle], until[low:middle], at[middle:high])
            asked.append(middle + np.flatnonzero(got >= 0))
            found.append(low + got[got >= 0])
            low = high
        q, v = (pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in (asked, found))
        cols = [rows.column("key").take(q), rows.column("at").take(q), rows.column("won").take(v)]
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in cols], names=["key", "t", "won"])

    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([*kept, b])
        names = [rows.column(c).combine_chunks() for c in ("key", "chunk", "lane")]
        differs = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in names]
        new = np.flatnonzero(pc.or_(pc.or_(*differs[:2]), differs[2]).to_numpy(zero_copy_only=False)) + 1
        if len(new):
            yield swept(rows.slice(0, int(new[-1])), new.tolist())
            kept = rows.slice(int(new[-1])).combine_chunks().to_batches()
        else:
            kept = rows.to_batches()
    if kept:
        rows = pa.Table.from_batches(kept)
        yield swept(rows, [rows.num_rows])


def winners(versions: DataFrame, asks: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(key, t, won) of those distinct (key, t) of asks that some version is usable at.

    versions: key, event, arrival, expiry and id (longs) and whatever else; won is a struct of event, early (the negated
    arrival), id and the other columns by their names, of which the greatest win among versions equal in all else.
    Versions and questions with a null in key or times are left out, as are versions that are never usable; a null id
    is less than any other. Rows may repeat.
    """
    others = [c for c in versions.columns if c not in ("key", "event", "arrival", "expiry")]
    rest = [F.col(f"`{c}`") for c in others if c != "id"]
    start = F.greatest("event", "arrival")
    usable = versions.where(F.col("key").isNotNull() & F.col("event").isNotNull() & F.col("arrival").isNotNull() & (start < F.col("expiry")))
    merged = usable.groupBy("key", "event", "arrival", "expiry").agg(F.max(F.struct("id", *rest)).alias("one"))
    last = F.floor((F.col("expiry") - 1) / span)
    won = F.struct("event", (-F.col("arrival")).alias("early"), *(F.col("one").getField(c).alias(c) for c in ("id", *(c for c in others if c != "id"))))
    placed = merged.select("key", F.explode(F.sequence(F.floor(start / span), last)).alias("chunk"), F.xxhash64("event", "arrival", "expiry").alias("tie"), start.alias("at"), F.col("expiry").alias("until"), won.alias("won"))
    asked = asks.where("key is not null and t is not null").select("key", F.floor(F.col("t") / span).alias("chunk"), F.col("t").cast("long").alias("at")).distinct()
    # What both have in common decides the lanes: one row a chunk, counted before its shuffle.
    counts = placed.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    lanes = counts.join(asked.select("key", "chunk").distinct(), ["key", "chunk"]).select("key", "chunk", F.ceil(F.col("n") / most).alias("lanes"))
    names = ["key", "chunk", "lane", "ask", "at", "until", "won"]
    left = placed.join(lanes, ["key", "chunk"]).withColumn("lane", F.pmod("tie", "lanes")).withColumn("ask", F.lit(False)).select(*names)
    right = asked.join(lanes, ["key", "chunk"]).withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)))
    kind = next(f.dataType for f in left.schema if f.name == "won")
    right = right.select("key", "chunk", "lane", F.lit(True).alias("ask"), "at", F.lit(None).cast("long").alias("until"), F.lit(None).cast(kind).alias("won"))
    both = left.unionByName(right).repartition("key", "chunk", "lane").sortWithinPartitions("key", "chunk", "lane", "ask", "won", "at")
    types = dict(both.dtypes)
    got = both.mapInArrow(_answers, f"key {types['key']}, t long, won {types['won']}")
    return got.groupBy("key", "t").agg(F.max("won").alias("won"))


def point_in_time(labels: DataFrame, versions: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """Every row of labels (key, t and whatever else), with won: the struct of ``winners``, null if no version is usable."""
    got = winners(versions, labels.select("key", "t"), span, most).withColumnRenamed("key", "won_key").withColumnRenamed("t", "won_t")
    return labels.join(got, (F.col("key") == F.col("won_key")) & (F.col("t") == F.col("won_t")), "left").drop("won_key", "won_t")


def _numbers(doc_id: Column) -> list[Column]:
    """The first four groups of eight digits of the id's SHA-256 as unsigned numbers; null for a null id."""
    digest = F.sha2(doc_id.cast("string").cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def label_features(labels: DataFrame, docs: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(doc_id, t, version_id, age, status, n_chars, lang) of every row of labels (doc_id).

    docs (doc_id, source, n_chars, lang) are the versions, with times from the hash of their ids. A label asks about its
    document's source, of several documents with its id about the smallest source; without document or source it has no
    winner. A label with a null id has a null t and no winner; a document with a null id is no version.
    """
    a, b, c, _ = _numbers(F.col("doc_id"))
    event = F.pmod(a, F.lit(SECONDS))
    versions = docs.select(F.col("source").alias("key"), event.alias("event"), (event - 60 + F.pmod(b, F.lit(300))).alias("arrival"), (event + F.pmod(c, F.lit(900))).alias("expiry"), F.col("doc_id").alias("id"), "n_chars", "lang")
    owners = docs.select("doc_id", "source").join(labels.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("source").alias("key"))
    asked = labels.select("doc_id", F.pmod(_numbers(F.col("doc_id"))[3], F.lit(SECONDS)).alias("t")).join(owners, "doc_id", "left")
    age = F.col("t") - F.col("won.event")
    status = F.when(F.col("won").isNull(), "none").when(age > FRESH, "stale").otherwise("fresh")
    out = point_in_time(asked, versions, span, most).select("doc_id", "t", F.col("won.id").alias("version_id"), age.alias("age"), status.alias("status"), "won")
    fresh = [F.when(F.col("status") == "fresh", F.col("won").getField(c)).alias(c) for c in ("n_chars", "lang")]
    return out.select("doc_id", "t", "version_id", "age", "status", *fresh)


def sql() -> str:
    """DuckDB SQL of ``label_features``: all usable versions of each label, ranked."""
    n = [f"cast('0x' || substr(sha256(cast(doc_id as varchar)), {1 + 8 * k}, 8) as bigint)" for k in range(4)]
    return f"""
with v as (
  select source, doc_id as version_id, n_chars, lang, {n[0]} % {SECONDS} as event, {n[1]} % 300 as late, {n[2]} % 900 as lasts from documents where doc_id is not null and source is not null),
l as (
  select row_number() over () as k, l.doc_id, {n[3].replace("doc_id", "l.doc_id")} % {SECONDS} as t, d.source
  from labels l left join (select doc_id, min(source) as source from documents group by doc_id) d on l.doc_id = d.doc_id),
won as (
  select l.k, v.* from l join v on l.source = v.source and v.event <= l.t and v.event - 60 + v.late <= l.t and l.t < v.event + v.lasts
  qualify row_number() over (partition by l.k order by v.event desc, v.late, v.version_id desc, v.n_chars desc nulls last, v.lang desc nulls last) = 1)
select l.doc_id, l.t, won.version_id, l.t - won.event as age,
  case when won.k is null then 'none' when l.t - won.event > {FRESH} then 'stale' else 'fresh' end as status,
  case when l.t - won.event <= {FRESH} then won.n_chars end as n_chars, case when l.t - won.event <= {FRESH} then won.lang end as lang
from l left join won on l.k = won.k
"""
