"""Bounded, repeatable samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, text: str = "text", key: str = "doc_id", modulus: int = 5) -> tuple[DataFrame, dict[int, float]]:
    """At most per_class labelled rows of each class, outside the held-out fifth, in the order of a hash of their keys.

    Returns (key, y, text) and, for each class, how many labelled rows a sampled one stands for. A key that is labelled
    twice counts once, with its largest label; null labels and keys without a document are left out.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key), modulus, 0)).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    sizes = {int(y): n for y, n in known.groupBy("y").count().collect()}
    order = F.xxhash64(F.col(key).cast("string"), F.lit(label))
    taken = [known.filter(F.col("y") == y).orderBy(order, key).limit(per_class) for y in (0, 1)]
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(taken[0].unionByName(taken[1])), key)  # 2 * per_class rows
    return rows, {y: n / min(n, per_class) for y, n in sizes.items() if n}
