"""Ranked search, browsing and look-up over entries (term, body)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import search_key, shard_letter, slug
from .scan import numbered

CAP = 80
#: Entries of a shard of the index, which bounds its posting lists; files that grams and entries are dealt to.
SHARD, BUCKETS = 65_536, 16
#: Bytes of entries whose grams a task sorts at a time; sorting takes some 15 times as much.
PORTION = 4 << 20


def score(term_key: Column, body_key: Column, query_key: Column) -> Column:
    """100 exact, 80 begins with, 60 in the term, 20 in the body, else -1 (Q1)."""
    return (
        F.when(term_key == query_key, 100).when(F.startswith(term_key, query_key), 80).when(F.contains(term_key, query_key), 60)
        .when(F.contains(body_key, query_key), 20).otherwise(-1)
    )


def hits(entries: DataFrame, query: str) -> DataFrame:
    """Entries that a query finds, with score; a query without letters or digits finds none."""
    key = search_key(F.lit(query))
    found = entries.withColumn("score", score(search_key("term"), search_key("body"), key))
    return found.where((F.col("score") >= 0) & (key != ""))


def ranked(entries: DataFrame, query: str, cap: int = CAP) -> DataFrame:
    """The best hits: by score, then term, then index; a top-k without a full sort (Q1)."""
    return hits(entries, query).orderBy(F.desc("score"), "term", "index").limit(cap)


def build_index(entries: DataFrame, folder: str, shard: int = SHARD, buckets: int = BUCKETS) -> None:
    """Writes a search index of entries (index, term, body) to a folder (Q1).

    entries: with their keys normalised once, numbered, by shard and bucket of the number. postings: for each gram (three
    characters of a key, the end of the key padded) and shard the numbers of the entries that have it, ascending; by bucket
    of the gram. Lists of a gram are put together for each batch of entries before the shuffle, and none is longer than a shard.
    """
    keyed = numbered(entries.select("index", "term", search_key("term").alias("tk"), search_key("body").alias("bk")), "n", ["index", "term"])
    keyed.withColumn("shard", F.floor(F.col("n") / shard)).withColumn("part", F.floor((F.col("n") % shard) / max(1, shard // buckets))).write.partitionBy("shard", "part").parquet(f"{folder}/entries")
    stored = entries.sparkSession.read.parquet(f"{folder}/entries")

    def lists_of(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        grams, owner = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for n, tk, bk in rows:
            found = np.unique(np.concatenate([gram_codes(tk or ""), gram_codes(bk or "")]))
            grams.append(found), owner.append(np.full(len(found), n, np.int64))
        grams, owner = np.concatenate(grams), np.concatenate(owner)
        where = owner // shard
        order = np.lexsort((owner, where, grams))
        grams, owner, where = grams[order], owner[order], where[order]
        cuts = np.flatnonzero((np.diff(grams, prepend=-1) != 0) | (np.diff(where, prepend=-1) != 0))
        lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(grams)).astype(np.int32)), pa.array(owner))
        return pa.RecordBatch.from_arrays([pa.array(grams[cuts]), pa.array(where[cuts]), lists], names=["gram", "shard", "ns"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in portions(batches, PORTION):
            yield lists_of(rows)

    made = stored.select("n", "tk", "bk").mapInArrow(each, "gram int, shard long, ns array<long>")
    lists = made.groupBy("gram", "shard").agg(F.array_sort(F.flatten(F.collect_list("ns"))).alias("ns"))
    placed = lists.withColumn("bucket", F.pmod(F.hash("gram"), F.lit(buckets))).repartition("bucket", "shard").sortWithinPartitions("bucket", "gram")
    placed.write.partitionBy("bucket").parquet(f"{folder}/postings")


def portions(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """The rows of batches in portions of up to ``most`` bytes of Arrow's, or of a single row: memory goes by it, not by a batch's size."""
    for b in batches:
        k = 0
        while k < b.num_rows:
            n = max(1, min(b.num_rows - k, int(most * b.num_rows // max(1, b.nbytes))))
            while n > 1 and b.slice(k, n).nbytes > most:
                n //= 2
            yield list(zip(*(c.to_pylist() for c in b.slice(k, n).columns)))
            k += n


def gram_codes(key: str) -> np.ndarray:
    """Three bytes from each place of a key as one number; after the end stand zeros, so that short strings begin grams too."""
    b = np.frombuffer(key.encode() + b"\0\0", np.uint8).astype(np.int32)
    return (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[: len(b) - 2]


def search(spark: SparkSession, folder: str, query: str, cap: int | None = CAP, buckets: int = BUCKETS) -> DataFrame:
    """index, term, score of the best hits of a query in an index, as ``ranked`` gives them; all hits without a cap.

    Reads the posting lists of the query's grams (of a query of one or two characters those that begin with it),
    intersects them shard by shard, fetches the entries that are left and scores these.
    """
    key = spark.range(1).select(search_key(F.lit(query)).alias("k")).first()["k"]
    stored = spark.read.parquet(f"{folder}/entries")
    if not key:
        return stored.where("false").select("index", "term", F.lit(0).alias("score"))
    postings = spark.read.parquet(f"{folder}/postings")
    b = key.encode()
    if len(b) < 3:
        low = int.from_bytes(b.ljust(3, b"\0"), "big")
        met = postings.where(F.col("gram").between(low, low + (1 << 8 * (3 - len(b))) - 1)).select("shard", F.explode("ns").alias("n")).distinct()
    else:
        wanted = sorted(set(gram_codes(key)[: len(b) - 2].tolist()))
        named = spark.createDataFrame([(g,) for g in wanted], "gram int").select(F.pmod(F.hash("gram"), F.lit(buckets)).alias("b"))
        some = postings.where(F.col("bucket").isin([r.b for r in named.distinct().collect()]) & F.col("gram").isin(wanted))
        both = some.groupBy("shard").agg(F.collect_list("ns").alias("lists")).where(F.size("lists") == len(wanted))  # a list a gram of the query
        met = both.select("shard", F.explode(F.reduce("lists", F.element_at("lists", 1), lambda x, y: F.array_intersect(x, y))).alias("n"))
    found = stored.join(met.select(F.col("shard").cast("int").alias("shard"), "n"), ["shard", "n"]).withColumn("score", score(F.col("tk"), F.col("bk"), F.lit(key)))
    out = found.where("score >= 0").select("index", "term", "score")
    return out.orderBy(F.desc("score"), "term", "index").limit(cap) if cap else out


def browse(entries: DataFrame, letter: str) -> DataFrame:
    """Entries filed under a letter; over a store partitioned by letter this prunes partitions (Q2)."""
    return entries.where(shard_letter("term") == letter.upper())


def by_slug(entries: DataFrame, wanted: str) -> DataFrame:
    """Entries whose term has a slug (Q3)."""
    return entries.where(slug("term") == wanted)


def top_by(df: DataFrame, measure: Column, k: int, *ties: str, largest: bool = True) -> DataFrame:
    """The k rows of largest or smallest measure, ties by the columns named (Q4, Q5, Q6 with k = 1)."""
    return df.orderBy(measure.desc() if largest else measure.asc(), *ties).limit(k)
