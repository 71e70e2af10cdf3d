"""Near-duplicate vectors: codes of iterative quantisation, multi-index Hamming tables, reranking by the vectors."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import group_numbers, in_groups, meetings, pairs, roots
from .common import partitions, rows_by_key, written
from .components import components
from .topk import finite

#: Vectors that the rotations are learned from, at most; all are indexed.
SAMPLE = 20_000
#: Chance that a pair just at the threshold is near in no table, and standard deviations by which its codes may differ more than expected.
MISSED, FAR = 0.01, 3.5
#: Bits of a key that may differ: each vector is filed under its key and the keys one bit away, so two vectors meet if theirs differ in two bits.
PROBED = 2


def rotations(x: np.ndarray, bits: int, many: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Mean and `many` projections (dim x bits): principal directions, each time rotated from another start by alternating
    binary codes B = sign(V R) with the rotation that brings V closest to them."""
    mean = x.mean(0)
    x = x - mean
    _, vectors = np.linalg.eigh(x.T @ x)
    top = vectors[:, ::-1][:, :bits]
    v = x @ top
    out = []
    for seed in range(many):
        r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (a @ b).T
        out.append(top @ r)
    return mean, np.stack(out)


def tables_of(n: int, dim: int, least: float) -> tuple[int, int, int]:
    """Bits of a table's key, so that a bucket keeps few rows at any size; tables, so that few pairs are missed; and the
    number of differing bits in all tables beyond which a pair is dropped."""
    bits = int(min(dim, 31, max(8, np.ceil(np.log2(max(2, n))))))
    p = np.arccos(least) / np.pi * 1.25  # chance that a bit differs; a quarter more, for codes about the mean
    near = sum(comb(bits, d) * p**d * (1 - p) ** (bits - d) for d in range(PROBED + 1))
    tables = max(1, int(np.ceil(np.log(MISSED) / np.log1p(-min(near, 0.9999)))))
    all_bits = bits * tables
    return bits, tables, int(np.ceil(all_bits * p + FAR * np.sqrt(all_bits * p * (1 - p))))


def once(table: np.ndarray, key: np.ndarray, differ: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whether pairs met in `key` of `table` are to be taken there: in the first table where their keys differ in PROBED
    bits at most, and there under the smaller of the keys that both are filed under."""
    first = (np.bitwise_count(differ) <= PROBED).argmax(1)
    each = np.arange(len(differ))
    x, u = differ[each, first], left[each, first]
    low = x & -x
    return (first == table) & (np.minimum(u ^ low, u ^ x ^ low) == key)


def near_duplicates(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Links between vectors of cosine >= least (double precision).

    Returns a row for each row: key, n_links, component_id (smallest key that links reach, its own included), kept.

    Equal vectors are one class from the start. The others' binary codes are cut into one key a table, and each vector is
    filed under its key and all keys one bit away. Ids and codes alone meet in the buckets, in blocks; rows without a partner
    whose whole code is near go no further. The vectors of the rest meet in the same blocks, the cosines are taken, and a
    task returns counts and stars. Keys have about log2(n) bits and the number of tables follows from it, so buckets stay
    small at any size; where the tables need more bits than a code has, another rotation gives the next code.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of unlike
    lengths with each other; repeated rows are copies that link; an empty table gives no rows; other columns are ignored.
    """
    spark, kind, n = vectors.sparkSession, dict(vectors.dtypes)[key], partitions(vectors.sparkSession)
    ok = finite(vector) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.col(key), F.when(F.coalesce(ok, F.lit(False)), F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    rows = written(rows.withColumn("c", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "itq-rows")
    classes = written(rows.filter("c IS NOT NULL").groupBy("c").agg(F.min(key).alias("low"), F.count("*").alias("copies"), F.first("v").alias("v")), "itq-classes")
    links = None
    for dim, size in sorted((r[0], r[1]) for r in classes.groupBy(F.size("v")).count().collect()):
        found = _links(classes.filter(F.size("v") == dim), dim, size, least, n)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = spark.createDataFrame([], "a long, b long, links long")
    links = written(links, "itq-links")
    counts = links.groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    named = classes.select("c", "low", "copies").join(components(links.select("a", "b")).withColumnRenamed("id", "c"), "c", "left").join(counts, "c", "left")
    named = written(named.select("c", "low", F.coalesce("root", "c").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "itq-named")
    named = named.join(named.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("c", "n_links", "component_id")
    out = rows.filter("c IS NOT NULL").select(key, "c").join(named, "c").select(key, "n_links", "component_id")
    out = out.union(rows.filter("c IS NULL").select(key, F.lit(0).cast("long"), F.col(key)))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, dim: int, size: int, least: float, n: int) -> DataFrame:
    spark = classes.sparkSession
    sample = np.array(classes.orderBy("c").limit(SAMPLE).select("v").toPandas()["v"].to_list(), float).reshape(-1, dim)
    key_bits, tables, far = tables_of(size, dim, least)
    code = min(dim, 64)
    each = max(1, code // key_bits)
    unit = lambda x: x / np.sqrt((x * x).sum(1, keepdims=True))
    scaled = lambda x: unit(x / np.abs(x).max(1, keepdims=True))  # noqa: E731  squares of large or small components stay finite
    model = spark.sparkContext.broadcast(rotations(scaled(sample), code, -(-tables // each)))

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mean, turns = model.value
        powers = (1 << np.arange(key_bits)).astype(np.int64)
        for pdf in batches:
            if len(pdf):
                x = scaled(np.stack(pdf["v"].to_list()).astype(float))
                keys = [((x - mean) @ t >= 0)[:, i * key_bits : (i + 1) * key_bits] @ powers for t in turns for i in range(each)][:tables]
                keys = np.stack(keys, 1).astype(np.int32)
                yield pd.DataFrame({"c": pdf["c"], "copies": pdf["copies"], "keys": list(keys), "code": [k.tobytes() for k in keys], "x": [r.tobytes() for r in x]})

    coded = written(classes.select("c", "copies", "v").mapInPandas(codes, "c long, copies long, keys array<int>, code binary, x binary"), "itq-codes")
    bucket, group = ["table", "h"], ["table", "h", "bi", "bj"]
    probes = F.array(F.lit(0), *[F.lit(1 << b) for b in range(key_bits)])
    filed = coded.select("c", "code", F.posexplode("keys").alias("table", "k")).withColumn("h", F.explode(F.transform(probes, lambda b: F.col("k").bitwiseXOR(b)))).drop("k")

    def candidates(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        code_ = np.frombuffer(b"".join(pdf["code"]), np.int32).reshape(len(pdf), -1)
        table, h = pdf["table"].to_numpy(), pdf["h"].to_numpy(np.int32)
        for i, j in pairs(group_numbers(pdf, group), (pdf["bi"] != pdf["bj"]).to_numpy(), pdf["side"].to_numpy(), 100_000):
            differ = code_[i] ^ code_[j]
            near = np.flatnonzero(np.bitwise_count(differ).sum(1) <= far)
            i, j = i[near], j[near]
            taken = once(table[i], h[i], differ[near], code_[i])
            yield i[taken], j[taken]

    def partnered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows_by_key(batches, group):
            has = np.zeros(len(pdf), bool)
            for i, j in candidates(pdf):
                has[i] = has[j] = True
            if has.any():
                yield pdf.loc[has, ["c", *group, "side"]]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows_by_key(batches, group):
            x = np.frombuffer(b"".join(pdf["x"]), float).reshape(len(pdf), -1)
            ids, copies, found = pdf["c"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), []
            for i, j in candidates(pdf):
                hit = np.einsum("ij,ij->i", x[i], x[j]) >= least
                found.append((i[hit], j[hit]))
            if found:
                i, j = (np.concatenate(y) for y in zip(*found, strict=True))
                links = np.zeros(len(pdf), np.int64)
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                root = roots(len(pdf), i, j)
                linked = np.flatnonzero(links)
                yield pd.DataFrame({"a": ids[linked], "b": ids[root[linked]], "links": links[linked]})

    met = in_groups(meetings(filed, bucket, "c"), group, 2 * n).mapInPandas(partnered, "c long, table int, h int, bi int, bj int, side int")
    met = written(met, "itq-met").join(coded.drop("keys"), "c")
    return in_groups(met, group, 2 * n).mapInPandas(compare, "a long, b long, links long")
