"""The latitude-time field of atmospheric CO2 from a station series and a surface that ends earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import fugacity
from . import prefix
from .climatology import smooth, smooth_cycle


def at_times(knots: DataFrame, queries: DataFrame, time: str, value: str, part: list[str] | None = None) -> DataFrame:
    """Linear interpolation of a series at the queries' times, null outside its range. time is a number.

    Knots and queries are one ordered set, in which each query sees the known values on both sides: no range join. The set is scanned
    in ranges, so a series may be of any length, or hold most of the rows. Times of knots are unique in a series.
    """
    part = part or []
    known = knots.filter(F.col(value).isNotNull()).select(*part, time, F.col(value).alias("_v"), F.lit(0).alias("_q"))
    both = known.unionByName(queries.select(*part, time).distinct().withColumns({"_v": F.lit(None).cast("double"), "_q": F.lit(1)}))
    got = prefix.known_around(both.withColumn("_t", F.col(time)), "_v", [time, "_q"], part, ["_t"]).filter("_q = 1")
    a, b, t, u = F.col("before._v"), F.col("after._v"), F.col("before._t"), F.col("after._t")
    blend = F.when(t == F.col(time), a).otherwise(a + (b - a) * (F.col(time) - t) / (u - t))  # a knot at the time itself comes before it
    return got.select(*part, time, blend.alias(value))


def regress(df: DataFrame, x: str, y: str, part: list[str], paired: bool = False) -> DataFrame:
    """Slope over the pairs, intercept = mean(y) - slope * mean(x), with mean(x) over all rows, or over the pairs only."""
    mean_x = F.avg(F.when(F.col(y).isNotNull(), F.col(x))) if paired else F.avg(x)
    fit = df.groupBy(*part).agg(F.regr_slope(y, x).alias("slope"), F.avg(y).alias("_y"), mean_x.alias("_x"))
    return fit.select(*part, "slope", (F.col("_y") - F.col("slope") * F.col("_x")).alias("intercept"))


def residual_cycle(df: DataFrame, residual: str, part: list[str], season: str, window: int = 3, iters: int = 1) -> DataFrame:
    """Mean residual by season, smoothed around the year."""
    return smooth_cycle(df.groupBy(*part, season).agg(F.avg(residual).alias("cycle")), "cycle", part, season, window, iters)


def offset_fix(df: DataFrame, original: str, filler: str, lat: str, time: str) -> DataFrame:
    """Shift the filler of each latitude so that it meets the original at the last time at which all latitudes have one."""
    full = df.groupBy(time).agg((F.count(original) == F.count("*")).alias("_full")).filter("_full").agg(F.max(time).alias("_last"))
    at_last = df.join(F.broadcast(full), F.col(time) == F.col("_last")).select(lat, (F.col(original) - F.col(filler)).alias("_shift"))
    return df.join(F.broadcast(at_last), lat, "left").withColumn(filler, F.col(filler) + F.coalesce("_shift", F.lit(0.0))).drop("_shift")  # a row for each latitude


def xco2_field(station: DataFrame, surface: DataFrame) -> DataFrame:
    """station: (year, widx, x); surface: (year, widx, ilat, y), shorter. Returns, for each window of the station and each latitude,

    the smoothed station value, the surface, its regression with the residuals' seasonal cycle moved to meet it, and the surface filled by that.
    """
    x = smooth(station.withColumn("_one", F.lit(0)), "x", ["_one"], ["year", "widx"], 3, 3).drop("_one")  # a row for each window of the calendar
    lats = surface.select("ilat").distinct().agg(F.collect_set("ilat").alias("l"))  # at most 720
    spine = x.join(F.broadcast(lats), F.lit(True)).select("year", "widx", "x", F.explode("l").alias("ilat"))
    both = spine.join(surface, ["year", "widx", "ilat"], "left")
    fit = both.join(F.broadcast(regress(both, "x", "y", ["ilat"])), "ilat").withColumn("line", F.col("slope") * F.col("x") + F.col("intercept"))
    fit = fit.withColumn("residual", F.col("y") - F.col("line"))
    cycle = residual_cycle(fit, "residual", ["ilat"], "widx")
    fit = fit.join(F.broadcast(cycle), ["ilat", "widx"], "left").withColumn("regressed", F.col("line") + F.coalesce("cycle", F.lit(0.0)))
    fit = fit.withColumn("_t", F.col("year") * 100 + F.col("widx"))
    fit = offset_fix(fit, "y", "regressed", "ilat", "_t")
    return fit.select("year", "widx", "ilat", F.col("x").alias("xco2_station"), F.coalesce("y", "regressed").alias("xco2_filled"), F.col("regressed").alias("xco2_regressed"), F.col("y").alias("xco2_raw"))


def fco2(cells: DataFrame, field: DataFrame, xco2: str = "xco2_filled") -> DataFrame:
    """Cells with sst (Celsius), msl (Pa) and sss get fco2. The field, windows x latitudes, is broadcast where the optimizer finds it small enough."""
    got = cells.join(field.select("year", "widx", "ilat", xco2), ["year", "widx", "ilat"], "left")
    return got.withColumn("fco2", fugacity(F.col(xco2), F.col("sst"), F.col("msl"), F.col("sss"))).drop(xco2)
