"""Exact top-k by inner product: tiled matrix products, partial selection in each tile, tree merging of the lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

#: Queries and candidates of one tile.
QUERY_BLOCK, SHARD = 2_048, 8_192
#: Lists that one merge step joins.
FAN_IN = 16
PACKED = "block int, dim int, n int, ids binary, vectors binary"
LISTS = "block int, shard int, n int, ids binary, found binary, scores binary"
#: Marks an empty place in a list.
NONE = -np.iinfo(np.int64).max


def finite(vector: str):
    """True where the vector is there and all its components are finite numbers."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ok, F.lit(False))


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "dim": pdf["dim"].iloc[:1], "n": [len(pdf)], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "vectors": [np.stack(pdf["v"].to_list()).astype(np.int64).tobytes()]})


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of each row, larger scores first and smaller ids first among equals; padded with NONE."""
    n, m = scores.shape
    if m > 4 * k:
        edge = np.partition(scores, m - k, axis=1)[:, m - k]
        rows, cols = np.nonzero(scores >= edge[:, None])  # everything tied with the k-th stays
    else:
        rows, cols = np.divmod(np.arange(n * m), m)
    s, i = scores[rows, cols], ids[rows, cols] if ids.ndim == 2 else ids[cols]
    order = np.lexsort((i, -s, rows))
    rows, s, i = rows[order], s[order], i[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(n))[rows]
    keep = (place < k) & (s != NONE)
    out_s, out_i = np.full((n, k), NONE), np.zeros((n, k), np.int64)
    out_s[rows[keep], place[keep]], out_i[rows[keep], place[keep]] = s[keep], i[keep]
    return out_s, out_i


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products. Doubles hold them wherever no sum can pass 2^53; beyond, integers of 64 bits do."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def exact_top_k(vectors: DataFrame, queries, k: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row where `queries` (a Column) holds, the k other rows of highest integer inner product of floor(scale * x).

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id. Vectors that are null, empty or hold a null
    or non-finite component take no part; vectors meet only those of their own length. A repeated id stands for as many
    candidates, but never for one of its own query. An empty table gives no rows.

    Blocks of queries meet shards of candidates by an equi-join on the shard's number; each meeting is one matrix product,
    of which only k places a query leave the task. Lists are merged FAN_IN at a time, so no task sees all of a query's.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(finite(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        F.size(vector).alias("dim"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale))).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-asked // QUERY_BLOCK))
    packed = lambda d, count: d.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")).groupBy("block", "dim").applyInPandas(_pack, PACKED)
    c = packed(rows.drop("asks"), shards).select(F.col("block").alias("shard"), "dim", F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
    q = packed(rows.filter("asks").drop("asks"), blocks).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                a, b = (np.frombuffer(x, np.int64).reshape(-1, r.dim) for x in (r.vectors, r.c_vectors))
                qi, ci = np.frombuffer(r.ids, np.int64), np.frombuffer(r.c_ids, np.int64)
                lists = []
                for at in range(0, len(a), 256):
                    s = products(a[at : at + 256], b)
                    s[qi[at : at + 256, None] == ci[None, :]] = NONE
                    lists.append(best(s, ci, k))
                yield _listed(r.block, r.shard, qi, np.concatenate([x[1] for x in lists]), np.concatenate([x[0] for x in lists]))

    def _listed(block: int, shard: int, ids: np.ndarray, found: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"block": [block], "shard": [shard], "n": [len(ids)], "ids": [ids.tobytes()], "found": [found.tobytes()], "scores": [scores.tobytes()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["ids"]])
        found, scores = (np.concatenate([np.frombuffer(x, np.int64).reshape(-1, k) for x in pdf[c]]) for c in ("found", "scores"))
        order = np.argsort(ids, kind="stable")
        ids, found, scores = ids[order], found[order], scores[order]
        own, at, many = np.unique(ids, return_index=True, return_counts=True)
        wide = int(many.max()) * k
        s, f = np.full((len(own), wide), NONE), np.zeros((len(own), wide), np.int64)
        row = np.repeat(np.arange(len(own)), many)
        place = (np.arange(len(ids)) - at[row])[:, None] * k + np.arange(k)
        s[row[:, None], place], f[row[:, None], place] = scores, found
        s, f = best(s, f, k)
        return _listed(pdf["block"].iloc[0], pdf["shard"].iloc[0], own, f, s)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ids, found, scores = np.frombuffer(r.ids, np.int64), *(np.frombuffer(x, np.int64).reshape(-1, k) for x in (r.found, r.scores))
                row, place = np.nonzero(scores != NONE)
                yield pd.DataFrame({"query_id": ids[row], "rank": (place + 1).astype(np.int32), "vec_id": found[row, place], "score": scores[row, place]})

    met = q.join(c, ["shard", "dim"]).repartition(max(1, min(shards * blocks, 4 * partitions(spark))), "block", "shard")
    lists, left = met.mapInPandas(tiles, LISTS), shards
    while True:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int")).groupBy("block", "shard").applyInPandas(merge, LISTS)
        left = -(-left // FAN_IN)
        if left <= 1:
            return lists.mapInPandas(rows_of, "query_id long, rank int, vec_id long, score long")
