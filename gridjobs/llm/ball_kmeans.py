"""Ball k-means on integer vectors: clusters are balls, only centroids that a ball can reach are neighbours, and only the rings
of a ball that lie within reach of a neighbour are compared, exactly, with the neighbours that reach them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, shared_dir, written
from .topk import finite

#: Vectors of a bucket of the written tables, about, and the most buckets.
BUCKET, MAX_BUCKETS = 500_000, 50_000
#: Scaled components stay under this, so that squared distances of 64 components fit 64 bits.
LIMIT = 2**27
STATE = "block long, cluster binary, distance binary, sums array<struct<c: int, r: long, s: array<long>>>"


class Balls(NamedTuple):
    """Centroids, and of each cluster the centroids that its ball can reach: their numbers and squared distances, nearest first."""

    centroids: np.ndarray
    near: list[np.ndarray]
    gaps: list[np.ndarray]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c: by one product in doubles where those hold every sum, else in integers."""
    top = max(float(np.abs(x).max(initial=0)), float(np.abs(c).max(initial=0)))
    if 4 * top * top * x.shape[1] < 2.0**53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row) ** 2).sum(1) for row in c.astype(np.int64)], 1)


def balls(centroids: np.ndarray, before: np.ndarray | None = None, radii: list[int | None] | None = None) -> Balls:
    """The balls about moved centroids. radii: each cluster's largest squared distance to its centroid before the move (None: empty).

    A member lies within the old radius plus the way its centroid moved, so a centroid at more than twice that is no neighbour.
    """
    gap = squared(centroids, centroids)
    near, gaps = [], []
    for i in range(len(centroids)):
        order = np.argsort(gap[i], kind="stable")
        order = order[order != i]
        if radii is not None:
            moved = int(((centroids[i] - before[i]) ** 2).sum())
            reach = -1 if radii[i] is None else isqrt(radii[i]) + isqrt(moved) + 2  # both roots rounded up
            order = order[gap[i][order] <= 4 * reach * reach] if reach >= 0 else order[:0]
        near.append(order)
        gaps.append(gap[i][order])
    return Balls(centroids, near, gaps)


def assign(x: np.ndarray, own: np.ndarray | None, model: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and its squared distance. own: clusters of the last round.

    With D the distance between two centroids, a member nearer than D/2 to its own is nearer to it than to the other. So a
    ball's neighbours, by rising D, cut it into a stable core, which nothing reaches, and rings; ring t meets t neighbours.
    """
    c = model.centroids
    if own is None:
        d = squared(x, c)
        cluster = d.argmin(1).astype(np.int32)
        return cluster, d[np.arange(len(x)), cluster]
    cluster, dist = own.astype(np.int32), np.zeros(len(x), np.int64)
    order = np.argsort(own, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        if not len(members):
            continue
        i = int(own[members[0]])
        d = squared(x[members], c[i : i + 1])[:, 0]
        dist[members] = d
        ring = np.searchsorted(model.gaps[i], 4 * d, side="right")
        for t in np.unique(ring[ring > 0]):
            rows = members[ring == t]
            with_own = np.sort(np.append(model.near[i][:t], i))
            e = squared(x[rows], c[with_own])
            best = e.argmin(1)
            cluster[rows], dist[rows] = with_own[best], e[np.arange(len(rows)), best]
    return cluster, dist


def partial_sums(x: np.ndarray, cluster: np.ndarray, dist: np.ndarray) -> list[dict]:
    """Of each cluster in a block: its sums by component, its number of vectors, the sum of their distances, and the largest."""
    out = []
    for c in np.unique(cluster):
        m = cluster == c
        s = [*x[m].sum(0, dtype=np.int64).tolist(), int(m.sum()), int(dist[m].sum())]
        out.append({"c": int(c), "r": int(dist[m].max()), "s": s})
    return out


class Tables:
    """Tables in the shared folder, in buckets of one column: tables of one column's buckets are joined without a shuffle."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, df: DataFrame, key: str) -> DataFrame:
        name = f"ball_kmeans_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, key).sortBy(key).option("path", f"{shared_dir(self.spark)}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: float = 256.0, dim: int = 64, seed: int = 2, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """k-means of the vectors of `dim` finite components, each as floor(scale * x); squared Euclidean distances, exact integers.

    Starts at the k vectors whose sha256 of "seed:key" is smallest. A round assigns every vector to the nearest centroid (ties:
    the smaller number), then moves each centroid that has vectors to the floor of their mean; after the rounds all are assigned
    once more. Returns key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors are packed into blocks once, in buckets. A round writes only each block's cluster numbers, in the same buckets, and
    the blocks' partial sums; the driver gets k rows of sums, never vectors. A lost task's block is computed again from its tables.

    Vectors that are null, of another length or with null or non-finite components have no row. A null key starts no centroid
    but is assigned; repeated rows count as often as they occur, and may start several equal centroids, of which the first gets
    all; fewer than k vectors give fewer clusters; an empty table gives no rows; other columns are ignored. A component of 2^27
    or more after scaling is an error, as distances would not fit their type.
    """
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)[key]
    kept = vectors.filter(finite(vector) & (F.size(vector) == dim)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    first = kept.filter("id IS NOT NULL").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), "v").limit(k).select("v").collect()
    if not first:
        return spark.createDataFrame([], f"{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    model = balls(np.floor(np.array([r.v for r in first]) * scale).astype(np.int64))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
            if np.abs(x).max() >= LIMIT:
                raise ValueError(f"a component of {vector} is {np.abs(x).max():.3g} after scaling")
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([block]), ids, pa.array([x.astype("<i4").tobytes()])], ["block", "ids", "x"])
            block += 1

    buckets = min(MAX_BUCKETS, max(partitions(spark), -(-kept.count() // BUCKET)))
    tables = Tables(spark, buckets)
    try:
        blocks = tables.write(kept.mapInArrow(packed, f"block long, ids array<{kind}>, x binary").repartition(buckets, "block"), "block")
        state = None
        for done in range(rounds + 1):
            state = tables.write(_assigned(blocks, state, model, dim, done == rounds), "block")
            sums, radii = _sums(state, len(model.centroids), dim)
            if done < rounds:
                moved = [[s // n for s in row[:dim]] if (n := row[dim]) else old for row, old in zip(sums, model.centroids.tolist(), strict=True)]
                model = balls(np.array(moved, np.int64), model.centroids, radii)
        rows = blocks.select("block", "ids").join(state.select("block", "cluster", "distance"), "block").mapInArrow(_rows, f"{key} {kind}, cluster int, distance long")
        found = written(rows, "ball-kmeans")
    finally:
        tables.drop()
    own = [row[dim + 1] for row in sums]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in model.centroids.tolist()]
    of = [(i, n, sum(own), d) for i, (n, d) in enumerate(zip(own, digest, strict=True))]
    return found.join(F.broadcast(spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )  # k rows


def _assigned(blocks: DataFrame, state: DataFrame | None, model: Balls, dim: int, last: bool) -> DataFrame:
    """Each block's clusters and partial sums; distances after the last round only."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(model)
    both = blocks.select("block", "x", F.lit(None).cast("binary").alias("cluster")) if state is None else blocks.select("block", "x").join(state.select("block", "cluster"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "cluster", "distance", "sums"]
        kind = pa.list_(pa.struct([("c", pa.int32()), ("r", pa.int64()), ("s", pa.list_(pa.int64()))]))
        for batch in batches:
            for block, data, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x = np.frombuffer(data, "<i4").reshape(-1, dim)
                c, d = assign(x, None if own is None else np.frombuffer(own, "<i4"), sent.value)
                out = [pa.array([block], pa.int64()), pa.array([c.astype("<i4").tobytes()]), pa.array([d.astype("<i8").tobytes() if last else None], pa.binary()), pa.array([partial_sums(x, c, d)], kind)]
                yield pa.RecordBatch.from_arrays(out, names)

    return both.mapInArrow(run, STATE)


def _sums(state: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int | None]]:
    """Of each cluster its sums, number of vectors and inertia, and its squared radius: k * (dim + 2) rows for the driver."""
    each = state.select(F.explode("sums").alias("p")).select("p.c", "p.r", F.posexplode("p.s").alias("i", "s"))
    sums, radii = [[0] * (dim + 2) for _ in range(k)], [None] * k
    for r in each.groupBy("c", "i").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"), F.max("r").alias("r")).collect():
        sums[r.c][r.i], radii[r.c] = int(r.s), r.r
    return sums, radii


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            c, d = np.frombuffer(batch.column(2)[i].as_py(), "<i4"), np.frombuffer(batch.column(3)[i].as_py(), "<i8")
            yield pa.RecordBatch.from_arrays([batch.column(1)[i].values, pa.array(c), pa.array(d)], ["id", "cluster", "distance"])
