"""Self-joins inside buckets without a row for each pair: blocks of a bucket meet in tasks, which return sums and stars."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block; a task holds two of them at a time.
BLOCK = 768


def meetings(rows: DataFrame, bucket: list[str], key: str, block: int = BLOCK) -> DataFrame:
    """The rows of buckets of two and more, once for each meeting of their block with another: adds bi, bj and side.

    A bucket of any size is dealt into blocks by a hash of the key, so that no task gets more than two blocks of it and
    every two rows of a bucket meet exactly once: within a block in (i, i), else where sides 0 and 1 of (i, j) meet.
    """
    many = rows.groupBy(*bucket).count().filter("count > 1").withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count")
    own = rows.join(many, bucket).withColumn("b", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    own = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return own.withColumns({"bi": F.least("b", "o"), "bj": F.greatest("b", "o"), "side": (F.col("b") > F.col("o")).cast("int")}).drop("b", "o", "blocks")


def in_groups(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows of a group side by side in one partition, for mapInPandas: groups may be many and small."""
    return rows.repartition(n, *keys).sortWithinPartitions(*keys)


def group_numbers(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(pdf), bool)
    for k in keys:
        v = pdf[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def pairs(group: np.ndarray, cross: np.ndarray, side: np.ndarray, most: int = 400_000):
    """Index pairs (i < j) of each group, in portions: all, or, where cross holds, those of unlike sides."""
    size = np.bincount(group) if len(group) else np.zeros(0, int)
    held, n = [], 0
    for d in range(1, int(size.max(initial=0))):
        i = np.flatnonzero(group[d:] == group[:-d])
        i = i[~cross[i] | (side[i] != side[i + d])]
        if len(i):
            held.append((i, i + d))
            n += len(i)
        if n >= most:
            yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            held, n = [], 0
    if n:
        yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    while (label[label] != label).any():
        label = label[label]
    return label
