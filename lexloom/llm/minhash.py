"""Near-duplicates by circulant MinHash (operator 13).

Signature: a first permutation scatters the hashes of a text's word shingles over [0, 2^32); coordinate k is the minimum
of a second one that is shifted round by k. So two permutations give all ROWS * BANDS coordinates.

Candidates: documents with an equal band of ROWS coordinates. Two sets of likeness 0.8 miss each other in all bands with
probability (1 - 0.8 ^ ROWS) ^ BANDS, under 2e-7; the likelier, the less. All members of a band's group are compared
with two of them; what these leave open (members not yet connected with each other) is settled by the rarest shingles of
just these documents, an exact prefix filter, so that a passage that very many documents share makes no square of pairs.

Verification: sizes, parities, then whole shingle sets made from the texts again (``near_copies``). Equal sets are one node.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, remove, shared_dir
from .components import connected_components
from .near_copies import common_shingles, head, lists, open_links, parity, shingles, star_links

WIDTH, ROWS, BANDS = 4, 5, 40
#: So many numbers of coordinates times shingles are worked on at a time.
CELLS = 1 << 17


def permuted(x: np.ndarray, key: int) -> np.ndarray:
    """A permutation of the 32-bit numbers (uint32), by key: xor-shifts and odd multiplications are all reversible."""
    x = x ^ np.uint32(key)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


def signature(sigs: np.ndarray, size: int = ROWS * BANDS, seed: int = 13) -> np.ndarray:
    """Coordinates (uint32) of a set that is not empty, given as hashes (int64)."""
    first = permuted((sigs.view(np.uint64) >> np.uint64(32)).astype(np.uint32), seed)
    shifts, out = np.arange(size, dtype=np.uint32)[:, None], np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(first), CELLS):  # a very long text goes part by part
        part = first[at : at + CELLS]
        step = max(1, CELLS // len(part))
        for k in range(0, size, step):
            here = permuted(part + shifts[k : k + step], seed + 1).min(axis=1)
            out[k : k + step] = np.minimum(out[k : k + step], here)
    return out


def bands(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Keys (int64) of the bands of signatures, one a row; equal only for equal bands, but for chance collisions."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), -1, rows)
    keys = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for j in range(rows):
        keys = (keys ^ parts[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """row, node (a hash of the shingle set, 0 for none), n (its size), keys (of its bands) and parity of docs (row, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 128) for k in range(0, b.num_rows, 128)):
                sets = [shingles(t, width) for t in part.column(1).to_pylist()]
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                full = [s for s in sets if len(s)]
                keys = iter(bands(np.stack([signature(s) for s in full])) if full else ())
                none = np.zeros(0, np.int64)
                columns = [lists([next(keys) if len(s) else none for s in sets]), lists([parity(s) if len(s) else none for s in sets])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), *columns], names=["row", "node", "n", "keys", "parity"])

    return docs.mapInArrow(each, "row struct<k0:boolean,k1:long,k2:long>, node long, n int, keys array<long>, parity array<long>")


def _heads(texts: DataFrame, width: int) -> DataFrame:
    """(sig, node, n, at): the rarest shingles of texts (node, text), by which sets of likeness 0.8 meet."""
    shared = texts.sparkSession.sparkContext.broadcast(common_shingles(texts.withColumnRenamed("node", "doc_id"), width))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 128) for k in range(0, b.num_rows, 128)):
                sets = [shingles(t, width) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int32()), lists([head(s, shared.value) for s in sets])], names=["node", "n", "head"])

    heads = texts.select("node", "text").mapInArrow(each, "node long, n int, head array<long>")
    return heads.select("node", "n", F.posexplode("head").alias("at", "sig")).select("sig", "node", "n", "at")


def near_dups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text; other columns are ignored).

    A text without words (null, empty, white space) has an empty set and is alone; one of fewer words than width has one
    shingle, of all. component_id is the smallest doc_id of the component; null ids belong to one but name none unless no
    other id is in it. Rows that repeat one id are documents of their own. kept: doc_id = component_id, false for null ids.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    key = [F.col("doc_id").isNull().alias("k0"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2")]
    folder = f"{shared_dir(spark)}/minhash-{uuid.uuid4().hex}"
    _sketches(docs.select(F.struct(*key).alias("row"), "text"), width).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    # All that is said of a set follows from it, so any row of a node gives it; dealt out by node once, then read by columns.
    rows.where("n > 0").groupBy("node").agg(F.min("row").alias("first"), *(F.any_value(c).alias(c) for c in ("n", "keys", "parity"))).write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")
    firsts, whole = sets.select("node", "first"), sets.select("node", "n", "parity")

    def texts(nodes: DataFrame) -> DataFrame:
        owners = firsts.join(nodes, "node", "left_semi").select("node", "first.*")
        return docs.select("text", *key).join(owners, ["k0", "k1", "k2"]).select("node", "text").dropDuplicates(["node"])

    groups = sets.select(F.explode("keys").alias("sig"), "node", "n", F.lit(0).alias("at"))
    found, left = star_links(groups, whole, texts, width)
    # Components that a band leaves apart are settled by the rarest shingles of their members.
    apart = cut(left.select("node", "root").distinct())
    heads = _heads(cut(texts(apart.select("node"))), width).join(apart, "node")
    mixed = heads.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m")).where("low < high").select("sig", "low", "m")
    met = heads.join(mixed, "sig").withColumn("outside", F.col("root") != F.col("low"))
    links = found.unionByName(open_links(met, whole, texts, width))
    roots = connected_components(links)
    labelled = firsts.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = labelled.groupBy("root").agg(F.min("first").alias("named")).select("root", F.when(~F.col("named.k0"), F.col("named.k1")).alias("component_id"))
    ids = labelled.join(named, "root").select("node", "component_id")
    doc_id = F.when(~F.col("row.k0"), F.col("row.k1"))
    facts = rows.select(doc_id.alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node"))
    out = cut(facts.join(ids, "node", "left").withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))))
    remove(spark, folder)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
