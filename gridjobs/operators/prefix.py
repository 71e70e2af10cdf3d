"""Ordered operations on long series: row numbers, nearest known values, rolling frames, without a window over all rows.

Rows are dealt to ranges of their order, each range is summed up to a row or two, a scan over these rows says what each range
inherits from those before and after it, and a local pass finishes. The series' length is bounded by the cluster, not by a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.shared import written

#: Rows of a block that a rolling frame is computed in.
BLOCK = 100_000


def both_ways(part: list[str], order: list[str | Column], upto: int = 0) -> tuple[WindowSpec, WindowSpec]:
    """The frame of all rows up to one (0: this one, -1: the one before it) in the order, and in the reverse order. The order must leave no ties.

    What follows a row is looked at in reverse: Spark goes through a frame that ends with the last row anew for every row, so its work
    grows with the square of the rows, while a frame that begins with the first row grows as it goes.
    """
    by = Window.partitionBy(*part)
    back, ahead = by.orderBy(*order), by.orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in order])
    return back.rowsBetween(Window.unboundedPreceding, upto), ahead.rowsBetween(Window.unboundedPreceding, upto)


def ranged(df: DataFrame, order: list[str], name: str = "_range") -> DataFrame:
    """The rows in a table, with the number of the range of `order` that each is in; ranges rise with the order. Equal keys share a range."""
    return written(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds the row's number in the order, from 0. Rows with equal keys are numbered in any order."""
    rows = ranged(df, order)
    counts = rows.groupBy("_range").count()  # a row for each range: as many as shuffle partitions at most
    before = F.sum("count").over(Window.orderBy("_range")) - F.col("count")
    at = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return rows.withColumn("_at", at).join(F.broadcast(counts.select("_range", before.alias("_before"))), "_range").withColumn(name, F.col("_before") + F.col("_at")).drop("_range", "_at", "_before")


def known_around(df: DataFrame, value: str, order: list[str], part: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """Adds, of each row, the last known value at or before it and the first at or after it, in its part: structs `before` and `after`.

    The structs hold `value` and the columns of `carry` of that row; they are null where no row of the part is known on that side.
    """
    part, fields = part or [], [value, *(carry or [])]
    rows = ranged(df.withColumn("_row", F.monotonically_increasing_id()), [*part, *order])
    order = [*order, "_row"]  # rows with equal keys come in one order both ways
    known = F.when(F.col(value).isNotNull(), F.struct(*fields))
    back, ahead = both_ways(["_range", *part], order)
    local = rows.withColumns({"before": F.last(known, True).over(back), "after": F.last(known, True).over(ahead)})

    # what parts that several ranges hold inherit: at most two parts of a range
    key = F.struct(*order)
    ends = rows.groupBy("_range", *part).agg(F.max_by(known, F.when(known.isNotNull(), key)).alias("_last"), F.min_by(known, F.when(known.isNotNull(), key)).alias("_first"))
    if part:
        ends = ends.join(ends.groupBy(*part).agg(F.count("*").alias("_ranges")).filter("_ranges > 1").drop("_ranges"), part, "left_semi")
    earlier, later = both_ways(part, ["_range"], -1)  # a row for each range
    inherited = ends.select("_range", *part, F.last("_last", True).over(earlier).alias("_earlier"), F.last("_first", True).over(later).alias("_later"))
    inherited = F.broadcast(inherited)  # at most two rows for each range
    if part:
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in part]
        got = local.alias("l").join(inherited.alias("r"), [F.col("l._range") == F.col("r._range"), *same], "left")
        got = got.select(*[F.col(f"l.{c}") for c in local.columns], "_earlier", "_later")
    else:
        got = local.join(inherited, "_range", "left")
    got = got.withColumns({"before": F.coalesce("before", "_earlier"), "after": F.coalesce("after", "_later")})
    return got.drop("_range", "_row", "_earlier", "_later")


def rolling(df: DataFrame, order: list[str], frames: Callable[[DataFrame, Callable], DataFrame], reach: int) -> DataFrame:
    """Window expressions whose frames reach at most so many rows to either side, over one series of any length.

    Rows are numbered and dealt to blocks; a row near a block's border goes to the next block too, as a guest, so every frame is whole.
    frames(rows, window) adds columns, where window(a, b) is the frame from a rows before to b rows after; guests are dropped then.
    """
    block = max(BLOCK, 2 * reach + 1)
    rows = numbered(df, order, "_n")
    own = F.expr(f"CAST(_n DIV {block} AS BIGINT)")
    blocks = F.array_distinct(F.array(own, F.expr(f"CAST(greatest(_n - {reach}, 0) DIV {block} AS BIGINT)"), F.expr(f"CAST((_n + {reach}) DIV {block} AS BIGINT)")))
    rows = rows.withColumns({"_own": own, "_block": blocks}).withColumn("_block", F.explode("_block"))
    window = lambda a, b: Window.partitionBy("_block").orderBy("_n").rowsBetween(a, b)
    return frames(rows, window).filter("_own = _block").drop("_n", "_own", "_block")


def interpolated(df: DataFrame, value: str, order: str, part: list[str] | None = None, at: Column | None = None) -> DataFrame:
    """Nulls between known values linearly by `at` (a number that rises with the order; default: the order itself); others stay."""
    rows = df.withColumn("_at", F.col(order) if at is None else at)
    got = known_around(rows, value, [order], part, ["_at"])
    a, b, t, u = F.col(f"before.{value}"), F.col(f"after.{value}"), F.col("before._at"), F.col("after._at")
    return got.withColumn(value, F.coalesce(F.col(value), F.when(u > t, a + (b - a) * (F.col("_at") - t) / (u - t)))).drop("_at", "before", "after")
