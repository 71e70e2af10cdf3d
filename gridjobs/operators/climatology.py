"""Climatologies, anomalies, deltas, smoothed series and cycles, and the model's feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import SPAN, center, per_year
from . import prefix

CELL = ["ilat", "ilon"]


def season(key: str, span: int = SPAN) -> Column:
    """Season of a window: its number, or the day of the year of its centre, by which leap years have one more group."""
    if key == "widx":
        return F.col("widx")
    return F.dayofyear(center(F.col("year"), F.col("widx"), span))


def climatology(cells: DataFrame, variables: list[str], key: str = "dayofyear") -> DataFrame:
    """Mean over the years by cell and season: season_key, clim_<variable>."""
    return cells.groupBy(*CELL, season(key).cast("int").alias("season_key")).agg(*[F.avg(v).alias(f"clim_{v}") for v in variables])


def long_term_mean(cells: DataFrame, variables: list[str]) -> DataFrame:
    return cells.groupBy(*CELL).agg(*[F.avg(v).alias(f"ltm_{v}") for v in variables])


def seasonal_anomaly(clim: DataFrame, ltm: DataFrame, variables: list[str]) -> DataFrame:
    """Climatology less the long-term mean: seas_<variable>."""
    return clim.join(ltm, CELL).select(*CELL, "season_key", *[(F.col(f"clim_{v}") - F.col(f"ltm_{v}")).alias(f"seas_{v}") for v in variables])


def anomaly(cells: DataFrame, clim: DataFrame, variables: list[str], key: str = "dayofyear") -> DataFrame:
    """Value less climatology: anom_<variable>. A cell's season always has a climatology, since it is part of it."""
    keyed = cells.withColumn("season_key", season(key).cast("int"))
    return keyed.join(clim, [*CELL, "season_key"]).withColumns({f"anom_{v}": F.col(v) - F.col(f"clim_{v}") for v in variables})


def deltas(cells: DataFrame, variables: list[str], span: int = SPAN) -> DataFrame:
    """Change since the window before, null where that window isn't there: delta_<variable>."""
    n = F.col("year") * per_year(span) + F.col("widx")
    w = Window.partitionBy(*CELL).orderBy("year", "widx")
    return cells.withColumns({f"delta_{v}": F.when(n - F.lag(n).over(w) == 1, F.col(v) - F.lag(v).over(w)) for v in variables})


def features(cells: DataFrame, variables: list[str], key: str = "widx") -> DataFrame:
    """Anomalies, deltas, climatologies and seasonal anomalies of each variable, by cell and window.

    All steps share the partitioning by cell, so the record is dealt out by cell once.
    """
    by_cell = cells.repartition(*CELL)
    clim, ltm = climatology(by_cell, variables, key), long_term_mean(by_cell, variables)
    out = anomaly(deltas(by_cell, variables), clim, variables, key).join(ltm, CELL)
    seas = {f"seas_{v}": F.col(f"clim_{v}") - F.col(f"ltm_{v}") for v in variables}
    return out.withColumns(seas).select("year", "widx", *CELL, *[f"{p}_{v}" for v in variables for p in ("anom", "delta", "clim", "seas")])


def smooth(series: DataFrame, v: str, part: list[str], order: list[str], window: int = 3, iters: int = 1, func: str = "avg") -> DataFrame:
    """Iterated centred rolling aggregate; a frame at the end is shorter, and null only if it holds nothing."""
    if not part:  # one series, however long

        def frames(rows: DataFrame, frame) -> DataFrame:
            for _ in range(iters):
                rows = rows.withColumn(v, F.call_function(func, F.col(v)).over(frame(-(window // 2), window - 1 - window // 2)))
            return rows

        return prefix.rolling(series, order, frames, iters * window)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(window // 2), window - 1 - window // 2)
    for _ in range(iters):
        series = series.withColumn(v, F.call_function(func, F.col(v)).over(w))
    return series


def smooth_cycle(cycle: DataFrame, v: str, part: list[str], order: str, window: int = 3, iters: int = 1, func: str = "avg") -> DataFrame:
    """The same on a closed cycle: it is put three times in a row, smoothed, and the middle copy kept."""
    three = cycle.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return smooth(three, v, part, ["_copy", order], window, iters, func).filter("_copy = 1").drop("_copy")
