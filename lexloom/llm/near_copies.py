"""Near copies for the pipeline: SimHash links and every pair of five-word Jaccard likeness of THRESHOLD or more.

Candidates: of two sets with likeness t or more, the first |A| - ceil(t |A|) + 1 shingles of each (its head), in any
one order of all shingles, have one in common. The order is by hash, with shingles often seen in a sample last; the
sample decides the cost only. So no pair is missed. Of each candidate pair the sizes, the places of the common
shingle and the parities of both sets must allow the likeness; what is left is compared shingle by shingle.

Only components count, so that a group of near copies makes no square of pairs: of those that share a shingle each is
compared with STARS of them, and only those not connected with the first of these afterwards with the others; of these
comparisons only what passes all tests but the last one leaves the join.

What is stored and shuffled are heads (a fifth of the shingles) and parities (a bit or two a shingle), not the sets;
the sets of the few documents that need an exact comparison are made from their texts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, remove, shared_dir
from .components import connected_components
from .simhash import _LOWER, SEED, fingerprint
from .simhash import links as simhash_links

WIDTH, THRESHOLD = 5, 0.8
#: Documents looked at for common shingles, in how many a shingle is common, and how many are remembered at most (8 bytes each).
SAMPLE, OFTEN, REMEMBERED = 4_000, 4, 200_000
#: How many members of those that share a shingle all others are compared with first.
STARS = 2
#: Members of a group that one task compares with the others at a time.
BLOCK = 1024


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Ascending distinct hashes (int64) of a text's word shingles; all words make one if they are no more than width."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64).view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64).view(np.int64))


def parity(sigs: np.ndarray) -> np.ndarray:
    """Bit h mod m is set if an odd number of hashes have it; m is a power of two of 2 to 4 bits a hash, 64 at least.

    The bits in which the parities of two sets differ are no more than the elements in which the sets do.
    """
    m = max(64, 1 << (2 * len(sigs) - 1).bit_length()) if len(sigs) else 64
    odd = np.bincount((sigs & (m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def common_shingles(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Shingles of many documents of docs (doc_id, text), ascending; a sample, which decides costs only."""
    n = docs.select(F.count("*")).first()[0]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 128) for k in range(0, b.num_rows, 128)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingles(t, width) for t in part.column(0).to_pylist()] or [np.zeros(0, np.int64)]))], names=["sig"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, n // SAMPLE))) == 0).select("text")
    often = some.mapInArrow(each, "sig long").groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") > OFTEN)
    return np.sort(np.array([r.sig for r in often.orderBy(F.desc("n"), "sig").limit(REMEMBERED).collect()], np.int64))


def lists(values: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate(values or [np.zeros(0, np.int64)]), pa.int64()))


def head(sigs: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of a set's n shingles, common ones last."""
    n = len(sigs)
    known = common[np.minimum(np.searchsorted(common, sigs), len(common) - 1)] == sigs if len(common) else np.zeros(n, bool)
    return np.concatenate([sigs[~known], sigs[known]])[: n + (-4 * n // 5) + 1] if n else sigs


def _rows(docs: DataFrame, key: list[Column], common: np.ndarray) -> DataFrame:
    """row, fp, node (a hash of the shingle set), n (its size), head (the shingles by which it meets others) and parity."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for b in batches:
            for part in (b.slice(k, 128) for k in range(0, b.num_rows, 128)):
                texts = part.column(1).to_pylist()
                sets = [shingles(t) for t in texts]
                heads = [head(s, common) for s in sets]
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
                fps = pa.array([fingerprint(t) for t in texts], pa.int64())
                sizes = pa.array([len(s) for s in sets], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), fps, pa.array(nodes, pa.int64()), sizes, lists(heads), lists([parity(s) for s in sets])], names=["row", "fp", "node", "n", "head", "parity"])

    return docs.select(F.struct(*key).alias("row"), "text").mapInArrow(each, "row struct<k0:boolean,k1:long,k2:long>, fp long, node long, n int, head array<long>, parity array<long>")


def sets_of(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, sigs) of texts (node, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 128) for k in range(0, b.num_rows, 128)):
                yield pa.RecordBatch.from_arrays([part.column(0), lists([shingles(t, width) for t in part.column(1).to_pylist()])], names=["node", "sigs"])

    return texts.select("node", "text").mapInArrow(each, "node long, sigs array<long>").dropDuplicates(["node"])


def _may_be_alike(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose sizes and parities allow a likeness of THRESHOLD.

    Likeness of 4 / 5 leaves the ninth part of both sizes at most to differ in. Sizes then differ by a fourth at most, so
    the longer parity is at most twice the other; folded in the middle it is that of the smaller modulus.
    """
    one, two = (whole.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"q{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").where(_parities_allow()).select("a", "b")


def _parities_allow() -> Column:
    """Whether sizes na and nb and parities qa and qb allow a likeness of THRESHOLD."""
    k = F.least(F.size("qa"), F.size("qb"))
    fold = lambda q: F.when(F.size(q) > k, F.zip_with(F.slice(q, F.lit(1), k), F.slice(q, k + 1, k), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(q))
    apart = F.aggregate(F.zip_with(fold("qa"), fold("qb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.expr("5 * least(na, nb) >= 4 * greatest(na, nb)") & (9 * apart <= F.col("na") + F.col("nb"))


def _alike(pairs: DataFrame, texts, width: int) -> DataFrame:
    """pairs (a, b) with likeness of THRESHOLD or more; texts gives (node, text) of what is asked for."""
    pairs = cut(pairs)
    sets = cut(sets_of(texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), width))
    one, two = sets.select(F.col("node").alias("a"), F.col("sigs").alias("sa")), sets.select(F.col("node").alias("b"), F.col("sigs").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(5 * F.col("common") >= 4 * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def _close(a: str, b: str) -> Column:
    """Likeness needs 4 / 9 of both sizes in common; after the first shingle in common no more than what is left can be."""
    left = F.least(F.col(f"n{a}") - F.col(f"p{a}"), F.col(f"n{b}") - F.col(f"p{b}"))
    return 9 * left >= 4 * (F.col(f"n{a}") + F.col(f"n{b}"))


def star_links(each: DataFrame, whole: DataFrame, texts, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of the members of groups with the first STARS of their group, and what these leave open.

    each: sig (a group), node, n and at (the place in the node's order of what the group shares; 0 where there is no
    order). Left open are groups with a member that is not connected with the group's first star: sig, node, n, at, root
    (its component), outside (not connected with the star), m (members of the group left open).
    """
    # A group may hold a large part of all nodes: it is counted and its stars are found before the shuffle, and joins on it can be split.
    shared = each.groupBy("sig").agg(F.count("*").alias("often")).where("often > 1")
    met = cut(each.join(shared, "sig").select("sig", "node", "n", "at", "often"))
    # First comes the member that meets most others in all its groups: what copies were made from is like all of them, they are not.
    met_by = met.groupBy("node").agg((-F.sum("often")).alias("rank"))
    first_by = [("rank", F.xxhash64("node")), *((F.xxhash64("node", F.lit(k)),) for k in range(1, STARS))]
    stars = met.join(met_by, "node").groupBy("sig").agg(*(F.min(F.struct(*by, "node", "n", "at")).alias(f"s{k}") for k, by in enumerate(first_by)))
    ends = F.explode(F.array(*(F.struct(F.col(f"s{k}.node").alias("a"), F.col(f"s{k}.n").alias("na"), F.col(f"s{k}.at").alias("pa")) for k in range(STARS)))).alias("s")
    pairs = met.join(stars, "sig").select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"), ends).select("s.*", "b", "nb", "pb")
    pairs = pairs.where((F.col("a") != F.col("b")) & _close("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = cut(_alike(_may_be_alike(pairs, whole), texts, width))
    roots = cut(connected_components(first))
    # The stars of a group are done with; of the others those are left that are not connected with its first star.
    tops = stars.select("sig", F.col("s0.node").alias("star"), F.array(*(F.col(f"s{k}.node") for k in range(STARS))).alias("stars"))
    tops = tops.join(roots, F.col("star") == F.col("node"), "left").select("sig", "stars", F.coalesce("root", "star").alias("top"))
    named = met.join(tops, "sig").where(~F.array_contains("stars", F.col("node"))).drop("stars").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = cut(named.select("sig", "node", "n", "at", "root", (F.col("root") != F.col("top")).alias("outside")))
    unsettled = named.groupBy("sig").agg(F.max("outside").alias("some"), F.count("*").alias("m")).where("some and m > 1").select("sig", "m")
    return first, cut(named.join(unsettled, "sig"))


def set_links(each: DataFrame, whole: DataFrame, texts, width: int = WIDTH) -> DataFrame:
    """Edges (a, b) that connect exactly what the pairs of likeness THRESHOLD or more within the groups of each connect.

    whole: distinct node, with n (its size) and parity. Where groups are shingles of heads, the pair's first common
    shingle is in both heads, and there the test by place holds; so whatever is alike passes it in one of them.
    """
    first, left = star_links(each, whole, texts, width)
    return first.unionByName(open_links(left, whole, texts, width))


def open_links(left: DataFrame, whole: DataFrame, texts, width: int = WIDTH) -> DataFrame:
    """Links (a, b) of members of a group in different components: left has sig, node, n, at, root, outside and m.

    One of each pair is outside. A large group is compared in blocks: its outsiders are dealt to lanes of BLOCK members,
    and each lane sees the group; what sizes, places or parities rule out does not leave the join.
    """
    marked = left.join(whole.select("node", F.col("parity").alias("q")), "node")
    lanes = F.ceil(F.col("m") / BLOCK).cast("long")
    side = lambda x: [F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"p{x}"), F.col("root").alias(f"r{x}"), F.col("q").alias(f"q{x}")]
    one = marked.where("outside").select("sig", F.pmod(F.xxhash64("node"), lanes).alias("lane"), *side("a"))
    two = marked.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), lanes - 1))).select("sig", "lane", *side("b"))
    more = one.join(two, (one.sig == two.sig) & (one.lane == two.lane) & (F.col("ra") != F.col("rb")) & _close("a", "b") & _parities_allow())
    return _alike(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), texts, width)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of docs, with all its columns: that of the smallest doc_id.

    Linked are texts of one fingerprint or of fingerprints within SimHash's radius, of one shingle set, or of sets with
    likeness THRESHOLD or more. Null ids come last; of rows with one id the one with the smallest text hash stays, and
    of equal rows one.
    """
    key = [F.col("doc_id").isNull().alias("k0"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2")]
    folder = f"{shared_dir(docs.sparkSession)}/shingles-{uuid.uuid4().hex}"
    _rows(docs, key, common_shingles(docs)).write.parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    firsts = cut(rows.groupBy("fp", "node").agg(F.min("row").alias("first")))
    # Head and parity follow from the set, so any row of a node gives them.
    whole = rows.where("n > 0").groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("head").alias("head"), F.any_value("parity").alias("parity"))

    def texts(nodes: DataFrame) -> DataFrame:
        owners = firsts.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("first").alias("first")).select("node", "first.*")
        return docs.select("text", *key).join(owners, ["k0", "k1", "k2"]).select("node", "text")

    likes = cut(set_links(whole.select("node", "n", F.posexplode("head").alias("at", "sig")), whole, texts))
    linked = likes.select(F.col("a").alias("node")).unionByName(likes.select(F.col("b").alias("node")))
    several = firsts.groupBy("node").agg(F.count("*").alias("m")).where("m > 1").select("node")
    ties = firsts.join(linked.unionByName(several).distinct(), "node", "left_semi").select(F.col("fp").alias("a"), F.col("node").alias("b"))
    roots = connected_components(simhash_links(firsts.select("fp").distinct()).unionByName(ties).unionByName(likes))
    named = firsts.join(roots, firsts.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    winners = cut(named.select("first.*"))
    remove(docs.sparkSession, folder)  # all that reads it is done
    names = docs.columns
    marked = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), *key)
    kept = marked.join(winners, ["k0", "k1", "k2"], "left_semi").dropDuplicates(["k0", "k1", "k2"])
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
