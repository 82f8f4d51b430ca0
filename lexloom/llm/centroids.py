"""Exact k-means with Drake's adaptive bounds (operator 11).

Vectors are integers, so that distances, ties and means are exact: component x becomes floor(scale * x), within LIMIT.
A round is one pass over blocks of vectors. Each vector keeps an upper bound of the distance to its centroid, lower bounds
of the distances to its next nearest centroids, in order (NEAR of them), and one lower bound of all remaining ones. When
centroids move, bounds follow by the distance moved. Where the upper bound lies below the first lower bound the assignment
is certified without any distance; where it lies below the z-th one only the centroids before it are measured and ordered
anew; else all. Bounds carry SLACK, far above any rounding of theirs, and decisions between measured centroids compare
whole numbers, so the result is that of measuring everything.

Blocks with their bounds are written to the shared folder after each round and read by the next; sums by centroid are
added up before the shuffle, and only these (k times the number of components) come to the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, remove, shared_dir

DIMS, SCALE, K, ROUNDS, NEAR, BLOCK = 64, 1024, 8, 10, 3, 2048
#: Whole components beyond this count as this; distances of 2 ** 12 components then fit 64 bits.
LIMIT, SLACK = 1 << 24, 1e-3
#: Up to this absolute component (and 1,024 of them) products of matrices in double precision are exact.
EXACT = 1 << 20


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x by rows of c) of int64 matrices."""
    if x.size and max(np.abs(x).max(), np.abs(c).max()) <= EXACT and x.shape[1] <= 1024:
        f, g = x.astype(np.float64), c.astype(np.float64)
        return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)[None]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1) if len(x) else np.zeros((0, len(c)), np.int64)


def own_squared(x: np.ndarray, c: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of x to row of[i] of c."""
    apart = x - c[of]
    return np.einsum("ij,ij->i", apart, apart)


class Bounds:
    """Of the vectors of a block: centroid, upper bound, the next nearest centroids, their lower bounds and that of the rest."""

    def __init__(self, near_to: np.ndarray, upper: np.ndarray, order: np.ndarray, lower: np.ndarray):
        self.near_to, self.upper, self.order, self.lower = near_to, upper, order, lower

    @staticmethod
    def unknown(n: int, k: int, near: int = NEAR) -> Bounds:
        b = min(near, k - 1)
        return Bounds(np.zeros(n, np.int16), np.full(n, np.inf), np.zeros((n, b), np.int16), np.zeros((n, b + 1)))

    @staticmethod
    def load(row: dict, n: int, k: int, near: int = NEAR) -> Bounds:
        b = min(near, k - 1)
        return Bounds(np.frombuffer(row["near_to"], np.int16).copy(), np.frombuffer(row["upper"]).copy(), np.frombuffer(row["order"], np.int16).reshape(n, b).copy(), np.frombuffer(row["lower"]).reshape(n, b + 1).copy())

    def dump(self) -> list[bytes]:
        return [x.tobytes() for x in (self.near_to, self.upper, self.order, self.lower)]

    def moved(self, by: np.ndarray) -> None:
        """Follows the centroids, each of which has moved by so much."""
        self.upper += by[self.near_to]
        self.lower[:, :-1] -= by[self.order]
        self.lower[:, -1] -= by.max()
        # A bound also holds for all behind it if these lie no lower.
        self.lower = np.minimum.accumulate(self.lower[:, ::-1], axis=1)[:, ::-1]

    def assign(self, x: np.ndarray, c: np.ndarray) -> int:
        """Makes near_to the nearest row of c (of equally near ones the first); returns how many distances were measured."""
        level, b = self._level(np.arange(len(x))), self.order.shape[1]
        some = np.flatnonzero(level)
        self.upper[some] = np.sqrt(own_squared(x[some], c, self.near_to[some]))  # tightened, most are certified then
        measured, level[some] = len(some), self._level(some)
        for z in range(1, b + 1):  # those before the z-th bound are put in order among themselves
            rows = np.flatnonzero(level == z)
            if len(rows):
                among = np.concatenate([self.near_to[rows, None], self.order[rows, :z]], axis=1)
                far, among = self._sorted(np.stack([own_squared(x[rows], c, among[:, j]) for j in range(z + 1)], axis=1), among)
                self.near_to[rows], self.upper[rows], self.order[rows, :z], self.lower[rows, :z] = among[:, 0], far[:, 0], among[:, 1:], far[:, 1:]
                measured += far.size
        rows = np.flatnonzero(level > b)
        if len(rows):
            d = squared(x[rows], c)
            far, among = self._sorted(d, np.broadcast_to(np.arange(len(c), dtype=np.int16), d.shape))
            self.near_to[rows], self.upper[rows], self.order[rows], self.lower[rows, :b] = among[:, 0], far[:, 0], among[:, 1 : b + 1], far[:, 1 : b + 1]
            self.lower[rows, b] = far[:, b + 1] if len(c) > b + 1 else np.inf
            measured += d.size
        return measured

    def _level(self, rows: np.ndarray) -> np.ndarray:
        """How many bounds, from the first, do not lie above the upper one."""
        return (self.lower[rows] <= self.upper[rows, None] + SLACK).sum(1)

    @staticmethod
    def _sorted(d: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances and centroids, each row by distance, then number."""
        at = np.lexsort((among, d), axis=1)
        return np.sqrt(np.take_along_axis(d, at, 1)), np.take_along_axis(among, at, 1)


_PARTS = "near_to binary, upper binary, order binary, lower binary"
_ROUND = f"ids array<long>, x binary, {_PARTS}, sums array<long>, measured long"


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<long>) of vectors (vec_id, embedding) with exactly ``dims`` components, none null or not finite."""
    good = (F.size("embedding") == dims) & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform("embedding", lambda v: F.greatest(F.lit(-LIMIT).cast("long"), F.least(F.lit(LIMIT).cast("long"), F.floor(v.cast("double") * scale))))
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def seeds(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hex SHA-256 of ``seed:vec_id``; rows of one id by their components. Null ids come last."""
    tie = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = whole.select(tie.alias("tie"), "x").orderBy(F.col("tie").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def _blocks(whole: DataFrame, dims: int, k: int) -> DataFrame:
    """Blocks of vectors with unknown bounds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(at, BLOCK) for at in range(0, b.num_rows, BLOCK)):
                x = part.column(1).flatten().to_numpy().astype(np.int32)
                n = part.num_rows
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0))
                parts = [pa.array([v], pa.binary()) for v in Bounds.unknown(n, k).dump()]
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary()), *parts], names=["ids", "x", "near_to", "upper", "order", "lower"])

    return whole.mapInArrow(each, f"ids array<long>, x binary, {_PARTS}")


def _assigned(blocks: DataFrame, centroids: np.ndarray, moves: np.ndarray) -> DataFrame:
    """Blocks after a round: bounds, and of each block the sums and numbers of its vectors by centroid."""
    k, dims = centroids.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, ids in zip(b.select(["x", "near_to", "upper", "order", "lower"]).to_pylist(), (b.slice(i, 1).column(0) for i in range(b.num_rows))):
                x = np.frombuffer(row["x"], np.int32).reshape(-1, dims).astype(np.int64)
                state = Bounds.load(row, len(x), k)
                state.moved(moves)
                measured = state.assign(x, centroids)
                sums = np.zeros((k, dims + 1), np.int64)
                for j in range(k):
                    mine = x[state.near_to == j]
                    sums[j, :dims], sums[j, dims] = mine.sum(0), len(mine)
                parts = [pa.array([v], pa.binary()) for v in state.dump()]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([row["x"]], pa.binary()), *parts, pa.array([sums.ravel().tolist()], pa.list_(pa.int64())), pa.array([measured], pa.int64())],
                    names=["ids", "x", "near_to", "upper", "order", "lower", "sums", "measured"],
                )

    return blocks.select("ids", "x", "near_to", "upper", "order", "lower").mapInArrow(each, _ROUND)


def _means(done: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means of each centroid's vectors; a centroid without any stays. Reads k * (dims + 1) sums."""
    k, dims = centroids.shape
    got = done.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros(k * (dims + 1), np.int64)
    for r in got:
        sums[r["at"]] = r.v
    sums = sums.reshape(k, dims + 1)
    return np.where(sums[:, dims:] > 0, sums[:, :dims] // np.maximum(sums[:, dims:], 1), centroids)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 3, dims: int = DIMS, scale: int = SCALE, report: list | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``whole_vectors``.

    vectors: vec_id and embedding; other columns are ignored. Rows that repeat are vectors of their own, null ids are kept
    and start no cluster while others can. Fewer vectors than k give as many clusters as there are vectors, none gives no
    rows. report, if given, gets for each round how many distances were measured.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors.select("vec_id", "embedding"), dims, scale)
    centroids = seeds(whole, k, seed)
    if not len(centroids):
        return whole.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256")).where("false")
    folder = f"{shared_dir(spark)}/centroids-{uuid.uuid4().hex}"
    _blocks(whole, dims, len(centroids)).write.parquet(f"{folder}/0")
    moves = np.zeros(len(centroids))
    for r in range(rounds + 1):  # the last one assigns only
        blocks = spark.read.parquet(f"{folder}/{r}")
        _assigned(blocks, centroids, moves).write.parquet(f"{folder}/{r + 1}")
        remove(spark, f"{folder}/{r}")
        done = spark.read.parquet(f"{folder}/{r + 1}")
        if report is not None:
            report.append(done.agg(F.sum("measured")).first()[0])
        if r < rounds:
            means = _means(done, centroids)
            moves, centroids = np.sqrt(own_squared(means, centroids, np.arange(len(means)))), means

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = np.frombuffer(b.column(1)[i].as_py(), np.int32).reshape(-1, dims).astype(np.int64)
                near = np.frombuffer(b.column(2)[i].as_py(), np.int16).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0)[i].values, pa.array(near), pa.array(own_squared(x, centroids, near))], names=["vec_id", "cluster", "distance"])

    found = cut(done.select("ids", "x", "near_to").mapInArrow(each, "vec_id long, cluster int, distance long"))
    remove(spark, folder)
    inertia = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows at most
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(j, inertia[j], sum(inertia.values()), digest[j]) for j in inertia]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
