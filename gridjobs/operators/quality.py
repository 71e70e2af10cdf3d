"""Checks of gridded data: each gives report rows (check, subject, ok, detail), and a policy says what failures do."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import SPAN, center, end, index, last_second, per_year, start, windows
from ..functions.cells import count, lat_index, lon_index
from . import prefix

#: Points on land (lat, lon), where the sea has no data.
LAND = ((20.0, 25.0), (-25.0, 135.0), (20.0, -100.0), (60.0, 100.0), (-33.0, 20.0))
KEY = ["year", "widx"]


def report(df: DataFrame, check: str, subject: Column, ok: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))


def window_name() -> Column:
    return F.concat_ws("-", F.col("year"), F.col("widx"))


def snap_time(df: DataFrame, time: str, days: float = 1.0, span: int = SPAN) -> DataFrame:
    """Adds the centre of the time's window and whether the time lies within `days` of it."""
    t = F.col(time)
    c = center(F.year(t), index(t, span), span)
    far = F.abs(F.unix_timestamp(t.cast("timestamp")) - F.unix_timestamp(c.cast("timestamp")))
    return df.withColumns({"center": c, "ok": far <= days * 86400})


def time_bounds(df: DataFrame, span: int = SPAN) -> DataFrame:
    """Adds the first and the last second of the window."""
    y, w = F.col("year"), F.col("widx")
    return df.withColumns({"bound_start": start(y, w, span).cast("timestamp_ntz"), "bound_end": last_second(y, w, span)})


def grid_matches(cells: DataFrame, res: float) -> DataFrame:
    """A row for each window: how many cells of the target grid it lacks, and how many of its cells aren't of that grid."""
    nlat, nlon = count(180, res), count(360, res)
    inside = F.coalesce(F.col("ilat").between(0, nlat - 1) & F.col("ilon").between(0, nlon - 1), F.lit(False))
    seen = cells.select(*KEY, "ilat", "ilon").distinct()
    both = seen.groupBy(*KEY).agg((F.lit(nlat * nlon) - F.count_if(inside)).alias("missing"), F.count_if(~inside).alias("foreign"))
    return report(both, "grid", window_name(), (F.col("missing") == 0) & (F.col("foreign") == 0), F.concat_ws(",", "missing", "foreign"))


def land_is_empty(cells: DataFrame, v: str, res: float, points: tuple = LAND, expect_null: bool = True) -> DataFrame:
    """A row for each window and land point that has a cell; five points are broadcast, so other cells stop at the scan."""
    rows = cells.sparkSession.createDataFrame(list(points), "plat double, plon double")
    rows = rows.select(lat_index(F.col("plat"), res).alias("ilat"), lon_index(F.col("plon"), res).alias("ilon")).distinct()
    got = cells.join(F.broadcast(rows), ["ilat", "ilon"])
    ok = F.col(v).isNull() if expect_null else F.col(v).isNotNull()
    return report(got, "land", F.concat_ws("/", window_name(), "ilat", "ilon"), ok, F.col(v))


def longitudes_present(cells: DataFrame, v: str, nlon: int) -> DataFrame:
    """A row for each window: does every longitude have a value?"""
    n = cells.groupBy(*KEY).agg(F.count_distinct(F.when(F.col(v).isNotNull(), F.col("ilon"))).alias("n"))
    return report(n, "longitudes", window_name(), F.col("n") == nlon, F.lit(nlon) - F.col("n"))


def years_full(cells: DataFrame, span: int = SPAN) -> DataFrame:
    """A row for each year: has it all its windows?"""
    n = cells.groupBy("year").agg(F.count_distinct("widx").alias("n"))
    return report(n, "full year", F.col("year"), F.col("n") == per_year(span), F.col("n"))


def single_year(cells: DataFrame) -> DataFrame:
    return report(cells.agg(F.count_distinct("year").alias("n")), "single year", F.lit("all"), F.col("n") == 1, F.col("n"))


def shape_matches(cells: DataFrame, nlat: int, nlon: int) -> DataFrame:
    """A row for each window: has it so many latitudes and longitudes, and a cell for every pair of them?"""
    from . import checks

    check = checks.shape(nlat, nlon)
    return report(checks.facts_of(cells, {"shape": check}), "shape", *check.row)


def times_match(df: DataFrame, time: str, hours: float = 1.0, span: int = SPAN) -> DataFrame:
    """A row for each time: strictly within so many hours of its window's centre?"""
    got = snap_time(df.select(time).distinct(), time, 1.0, span)
    far = F.abs(F.unix_timestamp(F.col(time).cast("timestamp")) - F.unix_timestamp(F.col("center").cast("timestamp")))
    return report(got, "times", F.col(time), far < hours * 3600, far)


def times_in_order(steps: DataFrame, time: str, hours: float = 1.0, span: int = SPAN) -> DataFrame:
    """The n-th time step of a year against the n-th window's centre: a row for each, ok if strictly within so many hours.

    steps: a row for each time step. They are numbered through ranges of time, so a missing or a doubled step moves all later ones of
    its year off their windows: those fail, a window that no step is left for fails as missing, and a step beyond the last as surplus.
    """
    spark = steps.sparkSession
    t = steps.select(F.col(time).alias("t")).filter("t IS NOT NULL").withColumn("year", F.year("t").cast("int"))
    numbers = prefix.numbered(t, ["t"], "n")
    ordinal = numbers.join(F.broadcast(numbers.groupBy("year").agg(F.min("n").alias("first"))), "year").select("year", "t", (F.col("n") - F.col("first")).cast("int").alias("widx"))
    first, last = t.agg(F.min("year"), F.max("year")).first()
    if first is None:
        return report(ordinal, "times", F.lit(""), F.lit(True), F.lit(""))
    expected = windows(spark, first, last, span).join(F.broadcast(t.select("year").distinct()), "year", "left_semi").select("year", "widx", "window_center")
    both = expected.join(ordinal, ["year", "widx"], "full")
    off = F.abs(F.unix_timestamp(F.col("t").cast("timestamp")) - F.unix_timestamp(F.col("window_center").cast("timestamp")))
    detail = F.when(F.col("t").isNull(), "missing").when(F.col("window_center").isNull(), "surplus").otherwise(off.cast("string"))
    return report(both, "times", window_name(), off < hours * 3600, detail)


def windows_have_data(cells: DataFrame, v: str, span: int = SPAN) -> DataFrame:
    """A row for each window of the years that occur: has it any value?"""
    first, last = cells.agg(F.min("year"), F.max("year")).first()
    if first is None:
        return report(cells.limit(0), "data", F.lit(""), F.lit(True), F.lit(""))
    n = cells.groupBy(*KEY).agg(F.count(v).alias("n"))
    all_ = windows(cells.sparkSession, first, last, span).select(*KEY).join(cells.select("year").distinct(), "year", "left_semi")
    return report(all_.join(n, KEY, "left"), "data", window_name(), F.col("n") > 0, F.coalesce("n", F.lit(0)))


# --- may a window be appended? ---------------------------------------------------------------------------------------


def not_stored(wanted: DataFrame, stored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The wanted windows that aren't stored."""
    return wanted.join(stored.select(*(keys or KEY)).distinct(), keys or KEY, "left_anti")


def append_verdict(wanted: DataFrame, stored: DataFrame, span: int = SPAN) -> DataFrame:
    """Of each wanted (variable, year, widx): may it be appended to what is stored of the variable, and why not.

    It must not be there, and it must follow the last stored window or, in an empty store, be the first of its year.
    """
    have = stored.select("variable", *KEY).distinct().withColumn("stored", F.lit(True))
    last = have.groupBy("variable").agg(F.max(F.struct(*KEY)).alias("last"))
    got = wanted.join(have, ["variable", *KEY], "left").join(last, "variable", "left")
    gap = F.datediff(start(F.col("year"), F.col("widx"), span), end(F.col("last.year"), F.col("last.widx"), span))
    reason = F.when(F.col("stored"), "exists").when(F.col("last").isNull() & (F.col("widx") > 0), "not first").when(F.col("last").isNotNull() & (gap != 0), "not adjacent").otherwise("safe")
    return got.select("variable", *KEY, reason.alias("reason"), (reason == "safe").alias("ok"))


def all_safe(verdicts: DataFrame) -> DataFrame:
    """A window is safe if it is for all its variables."""
    return verdicts.groupBy(*KEY).agg(F.bool_and("ok").alias("ok"))


def run_checks(checks: list[DataFrame], policy: str = "raise") -> DataFrame:
    """All reports as one. policy on failures: raise, warn or ignore."""
    if policy not in ("raise", "warn", "ignore"):
        raise ValueError(policy)
    both = reduce(lambda a, b: a.unionByName(b), checks)
    if policy != "ignore" and (failed := both.filter(~F.col("ok")).limit(5).collect()):
        said = "; ".join(f"{r.check} {r.subject}: {r.detail}" for r in failed)
        if policy == "raise":
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    return both
