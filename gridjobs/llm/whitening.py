"""Whitening of vectors: one aggregation sums the centred products of every pair of dimensions, as generated SQL expressions;
the covariance that these sums give is decomposed by LAPACK, and batches of vectors are projected by matrix products."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .topk import finite

#: Each entry becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries of such size after scaling are an error.
LIMIT = 2.0**52
#: Pairs that one aggregation sums; vectors of more than 100 dimensions take several passes.
PAIRS = 5_050
#: Components of a smaller share of the largest eigenvalue have no variance but for rounding.
NO_VARIANCE = 1e-12


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and x, the vector as whole numbers."""
    whole = lambda c: F.floor(c.cast("double") * SCALE)
    x = F.transform(vector, lambda c: F.when(F.abs(c.cast("double") * SCALE) < LIMIT, whole(c)).otherwise(F.raise_error(F.lit("an entry is too large")).cast("long")) + SHIFT)
    return vectors.filter(finite(vector)).select(F.col(key), x.alias("x"))


def centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Columns c0, c1, ...: x less its mean, whose whole part is taken off before the conversion to doubles."""
    return rows.selectExpr(*[f"CAST(x[{i}] - {s // n}L AS DOUBLE) - {(s % n) / n!r}D AS c{i}" for i, s in enumerate(sums)])


def covariance(columns: DataFrame, n: int) -> np.ndarray:
    """The covariance of centred columns, from the sums of products of its upper triangle."""
    names = columns.columns
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    out = np.zeros((len(names), len(names)))
    for at in range(0, len(pairs), PAIRS):
        part = pairs[at : at + PAIRS]
        row = columns.agg(*[F.expr(f"sum({names[i]} * {names[j]})") for i, j in part]).first()
        for (i, j), s in zip(part, row, strict=True):
            out[i, j] = out[j, i] = s / n
    return out


def projected(rows: DataFrame, kind: str, n: int, sums: list[int], directions: np.ndarray, exact: bool) -> DataFrame:
    """(id, deviation, w) of rows (id, x): the exact sum of (n*x - S)^2 and the centred vector times the directions.

    exact: every deviation fits a long; else they are summed as Python's integers, and null where they don't fit.
    """
    whole = np.array([s // n for s in sums], np.int64)
    rest, each = np.array([(s % n) / n for s in sums]), np.array([s % n for s in sums], np.int64 if exact else object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums)) - whole
            off = (x if exact else x.astype(object)) * n - each  # n*x - S, without the mean's whole part
            deviation = (off * off).sum(1).tolist()
            w = (x - rest) @ directions
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            fits = pa.array([d if d < 2**63 else None for d in deviation], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fits, lists], ["id", "deviation", "w"])

    return rows.mapInArrow(run, f"id {kind}, deviation long, w array<double>")


def whiten(vectors: DataFrame, components: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error) of each vector and leading component.

    x = floor(64 * c) + 1,000,000 of each entry; the fit list holds each distinct x vector once: n of them, with sums S. Components
    are unit eigenvectors of their covariance by falling eigenvalue e, numbered from 1. whitened is x - S/n projected on the component,
    over sqrt(e); deviation the exact sum of (n*x - S)^2 (null if it doesn't fit a long); explained e over the covariance's trace;
    identity_error the largest absolute entry of the whitened fit list's covariance less the identity.

    Passes: distinct vectors (copies are dropped before the shuffle), their sums, the pairs' products, the whitened pairs'
    products, the result. The driver gets one row of each pass and never a vector.

    Null or empty vectors and those with null or non-finite entries have no rows; a null key stays null; repeated rows each have
    their rows and count once in the fit; vectors of each length are a fit of their own; directions without variance (all vectors
    equal, or fewer vectors than dimensions) have no rows; an empty table gives none; other columns are ignored.
    """
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)[key]
    rows = integers(vectors, key, vector)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    out = [_whiten(rows.filter(F.size("x") == d), fit.filter(F.size("x") == d), d, components, key, kind) for d in sorted(r[0] for r in fit.select(F.size("x")).distinct().collect())]
    out = [x for x in out if x is not None]
    if not out:
        return spark.createDataFrame([], f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return reduce(DataFrame.unionByName, out)


def _whiten(rows: DataFrame, fit: DataFrame, dim: int, components: int, key: str, kind: str) -> DataFrame | None:
    found = fit.agg(F.count("*"), *[f(F.col("x")[i]) for i in range(dim) for f in (F.sum, F.min, F.max)]).first()
    n, sums = found[0], list(found[1::3])
    values, vectors = np.linalg.eigh(covariance(centred(fit, n, sums), n))
    values, vectors = values[::-1], vectors[:, ::-1]
    have = [i for i in range(min(components, dim)) if values[i] > NO_VARIANCE * max(values[0], 0.0) and values[i] > 0]
    if not have:
        return None
    bound = sum(max(abs(n * a - s), abs(n * b - s)) ** 2 for s, a, b in zip(sums, found[2::3], found[3::3], strict=True))
    directions = vectors[:, have] / np.sqrt(values[have])

    # covar_pop centres by itself: what rounding leaves of the whitened means is taken off too
    pairs = list(combinations_with_replacement(range(len(have)), 2))
    on_fit = projected(fit.select(F.lit(0).alias("id"), "x"), "int", n, sums, directions, bound < 2**63).select(*[F.col("w")[i].alias(f"w{i}") for i in range(len(have))])
    product = on_fit.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for (i, j), c in zip(pairs, product, strict=True))

    numbers = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(float(values[i] / values.sum())).alias("explained")) for i in have])
    got = projected(rows.select(F.col(key).alias("id"), "x"), kind, n, sums, directions, bound < 2**63)
    got = got.select(F.col("id").alias(key), "deviation", F.explode(F.arrays_zip(numbers.alias("of"), "w")).alias("z"))
    columns = [F.lit(n).cast("long").alias("n"), "deviation", F.col("z.w").alias("whitened"), F.col("z.of.explained").alias("explained"), F.lit(error).alias("identity_error")]
    return got.select(key, F.col("z.of.component").alias("component"), *columns)
