"""Sharding by longest-processing-time scheduling: groups of equal texts, sorted by size, go to the least-loaded shard."""

from __future__ import annotations

import heapq
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Runs of equal sizes beyond this many groups are dealt in one step, with the heap's result.
RUN = 64
#: Groups of one size, or rows of a shard, that are numbered together.
NUMBERED = 20_000
#: Ranges of a shard that are numbered separately, at most.
MAX_RANGES = 4_096
#: Groups with a larger share of the rows than one in HOT are joined by a broadcast; there are fewer than HOT of them.
HOT = 1_000


def run_counts(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` items of one size each bin gets, each item going to the least-loaded bin (ties: the lower number).

    The items take the `count` lowest of the levels load + j * size: whole levels below the last one, and of that one the lower bins.
    """
    below = lambda level: [max(0, -((x - level) // size)) for x in loads]  # noqa: E731  levels of each bin under `level`
    low, high = min(loads), min(loads) + size * count + 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(below(middle)) <= count else (low, middle)
    out = below(low)
    left = count - sum(out)
    for b, x in enumerate(loads):
        if left and x <= low and (low - x) % size == 0:
            out[b] += 1
            left -= 1
    return out


def longest_first(sizes: list[int], counts: list[int], bins: int) -> list[list[int]]:
    """Deal counts[i] items of sizes[i], from the largest size to the smallest, each item into the least-loaded bin (ties: the
    lower number). Returns how many items of sizes[i] each bin gets; sizes are positive and distinct."""
    heap = [(0, b) for b in range(bins)]
    out: list[list[int]] = [[]] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if counts[i] <= RUN:
            got = [0] * bins
            for _ in range(counts[i]):
                load, b = heap[0]
                heapq.heapreplace(heap, (load + sizes[i], b))
                got[b] += 1
        else:
            loads = [load for load, _ in sorted(heap, key=lambda x: x[1])]
            got = run_counts(loads, sizes[i], counts[i])
            heap = [(load + n * sizes[i], b) for b, (load, n) in enumerate(zip(loads, got, strict=True))]
            heapq.heapify(heap)
        out[i] = got
    return out


def assign_shards(docs: DataFrame, shards: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Deal documents into shards of nearly equal bytes; equal texts stay together.

    Returns key, size (UTF-8 bytes + 1), text_crc32, shard, slot (0, 1, ... without gaps in each shard).

    Equal texts are first summed to one row a group (partial sums before the shuffle, so that a hot text costs no more
    than any other). Groups of one size are alike to the scheduler, so the driver needs only how many groups each size has:
    it deals all groups, from the largest to the smallest, through a heap, and says how many of a size each shard gets. The
    sizes differ, so they are at most the square root of twice the bytes of all texts. Groups of one size are numbered on
    the cluster and take their shards in that order, which is a longest-first schedule at any number of groups.

    A null text counts as empty; repeated rows each keep a row; an empty table gives no rows; other columns are ignored.
    Ties between groups of one size go by a hash of the text, so the result doesn't depend on the rows' order. A single group larger than a shard's share makes its shard larger: groups aren't cut.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = written(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("g"),
        ),
        "shard-base",
    )
    groups = written(base.groupBy("g").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies")), "shard-groups")
    sizes = written(groups.groupBy("bytes").count(), "shard-sizes")
    known = sizes.toPandas()  # one row for each distinct size
    n_rows = base.count()
    dealt = longest_first(known["bytes"].tolist(), known["count"].tolist(), shards)
    plan = [(size, s, upto - n, upto) for size, got in zip(known["bytes"].tolist(), dealt, strict=True) for s, (n, upto) in enumerate(zip(got, accumulate(got), strict=True)) if n]
    plan = spark.createDataFrame(pd.DataFrame(plan, columns=["bytes", "shard", "from", "upto"]), "bytes long, shard int, from long, upto long")
    part = F.pmod(F.xxhash64("g"), F.ceil(F.col("count") / NUMBERED)).cast("int")
    numbered = groups.join(sizes, "bytes").select("g", "bytes", "copies", part.alias("part"))
    parts = numbered.groupBy("bytes", "part").count()
    before = F.sum("count").over(Window.partitionBy("bytes").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("bytes", "part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bytes", "part").orderBy("g")) - 1
    numbered = numbered.withColumn("place", place).join(parts, ["bytes", "part"]).select("g", "bytes", "copies", (F.col("start") + F.col("place")).alias("place"))
    inside = (F.col("place") >= F.col("from")) & (F.col("place") < F.col("upto"))
    sharded = written(numbered.join(plan.withColumnRenamed("bytes", "b"), (F.col("bytes") == F.col("b")) & inside).select("g", "copies", "shard"), "shard-of-group")
    hot = F.broadcast(sharded.filter(F.col("copies") * HOT > n_rows).select("g", "shard"))  # fewer than HOT rows
    placed = base.join(hot, "g").unionByName(base.join(hot, "g", "left_anti").join(sharded.filter(F.col("copies") * HOT <= n_rows).select("g", "shard"), "g"))
    ranges = min(MAX_RANGES, max(1, n_rows // NUMBERED))
    placed = written(placed.select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(ranges)).cast("int").alias("r")), "shard-rows")
    starts = placed.groupBy("shard", "r").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("r").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("shard", "r", F.coalesce(before, F.lit(0)).alias("start"))  # at most shards * MAX_RANGES rows
    place = F.row_number().over(Window.partitionBy("shard", "r").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("place", place).join(F.broadcast(starts), ["shard", "r"]).select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place") - 1).alias("slot"))
