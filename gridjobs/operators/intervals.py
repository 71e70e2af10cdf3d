"""Points in overlapping intervals, by bins of a number in place of a join on inequalities; windows with wings are such intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import SPAN, days, extended, windows


def seconds(t: Column) -> Column:
    return F.unix_timestamp(t.cast("timestamp"))


def within(points: DataFrame, intervals: DataFrame, at: str, first: str, last: str, width: float) -> DataFrame:
    """Every pair of a point and an interval with first <= at < last; numbers all three. A point in several intervals has several rows.

    An interval is listed in each bin of `width` that it touches, a point in its own, and equal bins are joined, so each pair meets
    once. Nulls and empty intervals have no partner. With a width of about an interval's length each has two bins.
    """
    bin_of = lambda c: F.floor(F.col(c) / F.lit(width))
    held = intervals.filter(F.col(first) < F.col(last)).withColumn("_bin", F.explode(F.sequence(bin_of(first), bin_of(last))))
    met = points.filter(F.col(at).isNotNull()).withColumn("_bin", bin_of(at)).join(held, "_bin")
    return met.filter((F.col(at) >= F.col(first)) & (F.col(at) < F.col(last))).drop("_bin")


def in_wings(times: DataFrame, time: str, span: int = SPAN) -> DataFrame:
    """Rows (year, widx, time) of each distinct time and the windows whose wings hold it: its own, and most often one or two others."""
    t = times.select(F.col(time)).distinct().withColumn("_t", seconds(F.col(time)))
    first, last = t.agg(F.min(F.year(time)), F.max(F.year(time))).first()
    if first is None:
        return t.select(F.lit(0).alias("year"), F.lit(0).alias("widx"), time).limit(0)
    wings = extended(windows(times.sparkSession, first - 1, last + 1, span).select("year", "widx"), span)
    wings = wings.select("year", "widx", seconds(F.col("wing_start")).alias("_a"), seconds(F.col("wing_end")).alias("_b"))
    return within(t, wings, "_t", "_a", "_b", 86400.0 * span).select("year", "widx", time)


def wing_weights(times: DataFrame, time: str, span: int = SPAN) -> DataFrame:
    """Rows (year, widx, day, time, w): how much each time inside a window's wings counts for each day of the window, linearly in time.

    A day at or between two times gets both (or the one it equals); a day outside the wings' times gets none. Days are at midnight.
    """
    held = in_wings(times, time, span).withColumn("_t", seconds(F.col(time)))
    held = held.withColumn("_next", F.struct(F.lead(time).over(Window.partitionBy("year", "widx").orderBy("_t")).alias("time"), F.lead("_t").over(Window.partitionBy("year", "widx").orderBy("_t")).alias("t")))
    of = days(held.select("year", "widx").distinct(), span).select("year", "widx", F.to_date("day").alias("day"))
    both = of.join(held, ["year", "widx"]).withColumn("_d", seconds(F.col("day")))
    hit, between = F.col("_d") == F.col("_t"), (F.col("_d") > F.col("_t")) & (F.col("_d") < F.col("_next.t"))
    share = (F.col("_d") - F.col("_t")) / (F.col("_next.t") - F.col("_t"))
    one = F.array(F.struct(F.col(time).alias("time"), F.lit(1.0).alias("w")))
    two = F.array(F.struct(F.col(time).alias("time"), (1 - share).alias("w")), F.struct(F.col("_next.time").alias("time"), share.alias("w")))
    return both.filter(hit | between).select("year", "widx", "day", F.inline(F.when(hit, one).otherwise(two))).select("year", "widx", "day", F.col("time").alias(time), "w")


def window_means(cells: DataFrame, v: str, time: str = "time", span: int = SPAN) -> DataFrame:
    """Fields at irregular times, interpolated to the days of each window from the times in its wings, and averaged over these days.

    A day is null if a time that it needs has no value; the mean skips such days, and n says how many it has. Cells are dealt out by
    place once; the times' weights, two rows for each day of a window, are joined to them, and days and windows are summed up in place.
    """
    weights = wing_weights(cells, time, span)
    met = cells.select(time, "ilat", "ilon", v).repartition("ilat", "ilon").join(F.broadcast(weights), time)
    full = F.sum(F.when(F.col(v).isNotNull(), F.col("w"))) > 1 - 1e-9
    daily = met.groupBy("ilat", "ilon", "year", "widx", "day").agg(F.when(full, F.sum(F.col("w") * F.col(v))).alias(v))
    return daily.groupBy("ilat", "ilon", "year", "widx").agg(F.avg(v).alias(v), F.count(v).alias("n"))
