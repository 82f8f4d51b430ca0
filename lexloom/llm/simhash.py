"""SimHash near-duplicates through covering locality-sensitive hashing (operator 10).

Fingerprints: every word shingle is hashed to 64 bits, and each fingerprint bit is the
majority of the shingles' bits. Candidates: every bit position has a non-zero vector
m(i) of GF(2)^(r+1), and mask v keeps the bits with <m(i), v> = 1. The at most r vectors
of the differing bits cannot span GF(2)^(r+1), so some mask avoids all of them: every
pair within radius r collides in at least one of the 2^(r+1) - 1 tables.

Within a bucket no pairs are formed. Two fingerprints within radius 2 share a point at
distance at most 1 from each, so each member offers itself and its one-bit changes
(in the bits the mask leaves out) as meeting points, and points with two or more members
link these to their smallest. A meeting point has at most 65 members, whatever the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components

BITS, RADIUS, SEED = 64, 2, 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes.split knows ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # a very long text unpacks a block at a time
        block = np.array(hashes[k : k + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row of (doc_id, text). Null texts count as empty; rows repeat as they do in docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 512) for k in range(0, b.num_rows, 512)):
                fps = pa.array([fingerprint(t, width) for t in part.column(1).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), fps], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, fp long")


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks, as unsigned integers; bit i belongs to vector 1 + i mod (2^(r+1) - 1)."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin((1 + i % n) & v).count("1") % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly the pairs within RADIUS bits.

    fps has one column fp of distinct longs. Pairs within the radius may be joined through a
    third fingerprint instead of directly; their component is the same.
    """
    if RADIUS != 2:
        raise ValueError("meeting points one bit away serve radius 2")
    tables = [(k, _signed(m), [0, *(_signed(1 << i) for i in range(BITS) if not m >> i & 1)]) for k, m in enumerate(masks())]
    keyed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m, _ in tables))).alias("b")).select("fp", "b.t", "b.key")
    # Most buckets hold one fingerprint; only the others go on. The count is combined before its shuffle.
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key")
    members = keyed.join(shared, ["t", "key"], "left_semi")
    flips = F.array(*(F.array(*(F.lit(x) for x in free)) for _, _, free in tables))
    points = members.select("t", "fp", F.explode(F.element_at(flips, F.col("t") + 1)).alias("flip")).select("t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
    met = points.groupBy("z").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return met.select("a", F.explode("all").alias("b")).where("a <> b")


def components(fps: DataFrame) -> DataFrame:
    """component_id of every row of (doc_id, fp): the smallest doc_id that links of RADIUS bits reach.

    Equal fingerprints are one node, so that copies cost nothing beyond their own row.
    Null doc_ids belong to components but never name one unless alone in it.
    """
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected_components(links(nodes.select("fp")))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = labelled.join(named, "root").select("fp", "component_id")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def simhash_near_dups(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every row of docs (doc_id, text; other columns are ignored).

    Texts without words have fingerprint zero and link like any other. An empty table gives no rows.
    """
    out = components(cut(fingerprints(docs, width)))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row of each near-duplicate component of docs, with all its columns: that of the smallest doc_id.

    Null ids come last; of rows with one id the one with the smallest text hash stays, and of equal rows one.
    """
    key = [F.col("doc_id").isNull().alias("k0"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2")]
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 512) for k in range(0, b.num_rows, 512)):
                fps = pa.array([fingerprint(t, width) for t in part.column(1).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), fps], names=["row", "fp"])

    rows = docs.select(F.struct(*key).alias("row"), "text").mapInArrow(each, "row struct<k0:boolean,k1:long,k2:long>, fp long")
    firsts = cut(rows.groupBy("fp").agg(F.min("row").alias("first")))
    roots = connected_components(links(firsts.select("fp")))
    named = firsts.join(roots, firsts.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    winners = named.select("first.*")
    names = docs.columns
    marked = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), *key)
    kept = marked.join(winners, ["k0", "k1", "k2"], "left_semi").dropDuplicates(["k0", "k1", "k2"])
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
