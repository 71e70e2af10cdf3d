"""From a source grid to a target grid: block means with spread, linear interpolation by weight tables, gaps along longitude."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cells import count, lat_center, like, lon_center, wind_moments
from .prefix import both_ways


def target_grid(spark: SparkSession, res: float) -> DataFrame:
    """Every cell of the globe: ilat, ilon, lat, lon of its centre. Cells are numbered in one range, so no join is needed."""
    nlon = count(360, res)
    cells = spark.range(count(180, res) * nlon)
    cells = cells.select(F.floor(F.col("id") / nlon).cast("int").alias("ilat"), (F.col("id") % nlon).cast("int").alias("ilon"))
    return cells.select("ilat", "ilon", lat_center(F.col("ilat"), res).alias("lat"), lon_center(F.col("ilon"), res).alias("lon"))


def grid_edges(spark: SparkSession, res: float) -> DataFrame:
    """axis, i, edge: the cells' borders, one more than cells."""
    out = [spark.range(count(extent, res) + 1).select(F.lit(axis).alias("axis"), F.col("id").cast("int").alias("i"), (F.col("id") * res - extent / 2).alias("edge")) for axis, extent in (("lat", 180.0), ("lon", 360.0))]
    return out[0].union(out[1])


def coarsen(cells: DataFrame, variables: list[str], window: list[str], factor: int, exclude: list[str] | None = None) -> DataFrame:
    """Mean of each block of factor x factor cells in a window, nulls skipped, and the population spread of all but uncertainties and flags.

    A block at the grid's border may be incomplete. One pass with partial sums before the shuffle, whatever the rows of a block.
    """
    if factor < 1:
        raise ValueError("the source grid is coarser than the target grid")
    plain = like(cells.select(*variables)) if exclude is None else exclude
    out = [F.avg(v).alias(v) for v in variables] + [F.stddev_pop(v).alias(f"{v}_sigma_regrid") for v in variables if v not in plain]
    return cells.groupBy(*window, F.floor(F.col("ilat") / factor).cast("int").alias("ilat"), F.floor(F.col("ilon") / factor).cast("int").alias("ilon")).agg(*out)


def linear_weights(spark: SparkSession, source: list[float], target: list[float], src: str, dst: str, weight: str) -> DataFrame:
    """Rows (src, dst, weight) of linear interpolation from sorted source to target positions; targets outside get none."""
    from bisect import bisect_right

    rows = []
    for d, x in enumerate(target):
        if not source[0] <= x <= source[-1]:
            continue
        i = min(bisect_right(source, x) - 1, len(source) - 2) if len(source) > 1 else 0
        t = (x - source[i]) / (source[i + 1] - source[i]) if len(source) > 1 else 0.0
        rows += [(i + k, d, w) for k, w in ((0, 1 - t), (1, t)) if w > 0]
    return spark.createDataFrame(rows, f"{src} int, {dst} int, {weight} double")


def interpolate(cells: DataFrame, variables: list[str], window: list[str], lat_weights: DataFrame, lon_weights: DataFrame) -> DataFrame:
    """Bilinear: weights (ilat, jlat, wlat) and (ilon, jlon, wlon), tables of one axis each, are broadcast.

    A target cell is null unless all cells with weight have a value; one with no such cell has no row.
    """
    w = F.col("wlat") * F.col("wlon")
    got = cells.join(F.broadcast(lat_weights), "ilat").join(F.broadcast(lon_weights), "ilon")
    value = lambda v: F.when(F.sum(F.when(F.col(v).isNotNull(), w)) > 1 - 1e-9, F.sum(w * F.col(v))).alias(v)
    return got.groupBy(*window, F.col("jlat").alias("ilat"), F.col("jlon").alias("ilon")).agg(*[value(v) for v in variables])


def regrid(cells: DataFrame, variables: list[str], window: list[str], factor: int, source_res: float, target_res: float) -> DataFrame:
    """Coarsen by a factor, then interpolate the block centres to the target centres, as floats; the same centres need no interpolation."""
    spark, coarse = cells.sparkSession, coarsen(cells, variables, window, factor)
    names, res = [c for c in coarse.columns if c not in (*window, "ilat", "ilon")], source_res * factor
    if abs(res - target_res) > 1e-12:
        axes = []
        for extent, a in ((180.0, "lat"), (360.0, "lon")):
            n, m = count(extent, res), count(extent, target_res)
            axes.append(linear_weights(spark, [(i + 0.5) * res for i in range(n)], [(i + 0.5) * target_res for i in range(m)], f"i{a}", f"j{a}", f"w{a}"))
        coarse = interpolate(coarse, names, window, *axes)
    return coarse.select(*window, "ilat", "ilon", *[F.col(v).cast("float").alias(v) for v in names])


def neighbours_along(value: Column, order: Column, part: list[str]) -> tuple[Column, Column, Column, Column]:
    """Of each row the last known value and its place before or at it, and the next ones."""
    back, ahead = both_ways(part, [order])
    at = F.when(value.isNotNull(), order)
    return F.last(value, True).over(back), F.last(at, True).over(back), F.last(value, True).over(ahead), F.last(at, True).over(ahead)


def between(value: Column, order: Column, part: list[str], limit: int | None = None) -> Column:
    """Linear interpolation between known neighbours in order; limit: at most so many after the known one before."""
    a, ia, b, ib = neighbours_along(value, order, part)
    ok = (ib > ia) & ((order - ia) <= limit) if limit else ib > ia
    return F.coalesce(value, F.when(ok, a + (b - a) * (order - ia) / (ib - ia)))


def fill_lon_limited(cells: DataFrame, v: str, window: list[str], nlon: int, limit: int = 2) -> DataFrame:
    """Nulls of a full row of longitudes by linear interpolation, at most `limit` in each gap, across the date line.

    As a row rotated by half is interpolated, its gaps at the grid's border (0 degrees of longitude by then) stay.
    """
    turned = F.pmod(F.col("ilon") + nlon // 2, F.lit(nlon))
    return cells.withColumn("_o", turned).withColumn(v, between(F.col(v), F.col("_o"), [*window, "ilat"], limit)).drop("_o")


def fill_lon_gap(cells: DataFrame, v: str | list[str], window: list[str], nlon: int) -> DataFrame:
    """Longitudes without any value in a window are interpolated from their neighbours, the date line included; other cells stay.

    Rows are dealt out by window once, which serves longitudes and latitudes of all variables; a window is one grid at most.
    """
    names = [v] if isinstance(v, str) else v
    by_lon, turned = Window.partitionBy(*window, "ilon"), F.pmod(F.col("ilon") + nlon // 2, F.lit(nlon))
    out = cells.repartition(*window).withColumns({"_o": turned} | {f"_empty_{x}": F.count(x).over(by_lon) == 0 for x in names})
    filled = {x: F.when(F.col(f"_empty_{x}"), between(F.col(x), F.col("_o"), [*window, "ilat"])).otherwise(F.col(x)) for x in names}
    return out.withColumns(filled).select(*cells.columns)


def to_daily(cells: DataFrame, v: str, time: str = "day") -> DataFrame:
    """Fields at irregular days (an integer day number) to every day between, linearly in time, by a broadcast table of the times' weights."""
    times = cells.select(F.col(time).alias("t0")).distinct()
    nxt = times.withColumn("t1", F.lead("t0").over(Window.orderBy("t0")))  # distinct times only
    step = F.col("d") - F.col("t0")
    days = nxt.withColumn("d", F.explode(F.sequence(F.col("t0"), F.coalesce(F.col("t1") - 1, F.col("t0")))))
    w = F.when(F.col("t1").isNotNull(), step / (F.col("t1") - F.col("t0"))).otherwise(0.0)
    pairs = days.select(F.col("d"), F.explode(F.array(F.struct(F.col("t0").alias("t"), (1 - w).alias("w")), F.struct(F.col("t1").alias("t"), w.alias("w")))).alias("p")).select("d", F.col("p.t").alias(time), F.col("p.w").alias("w")).filter("w > 0")
    got = cells.join(F.broadcast(pairs), time)  # two rows for each day of the record
    full = F.sum(F.when(F.col(v).isNotNull(), F.col("w"))) > 1 - 1e-9
    return got.groupBy("ilat", "ilon", F.col("d").alias(time)).agg(F.when(full, F.sum(F.col("w") * F.col(v))).alias(v))


def nearest_table(spark: SparkSession, source: list[float], target: list[float], tolerance: float) -> DataFrame:
    """Rows (src, dst): the nearest source of each target within the tolerance; of two as near, the larger."""
    rows = []
    for d, x in enumerate(target):
        i = min(range(len(source)), key=lambda k: (abs(source[k] - x), -source[k]))
        if abs(source[i] - x) <= tolerance:
            rows.append((i, d))
    return spark.createDataFrame(rows, "src int, dst int")


def hourly_wind(cells: DataFrame, window: list[str], factor: int, u: str = "u10", v: str = "v10") -> DataFrame:
    """Moments of hourly wind, coarsened with their spread; the speed is the root of the mean second moment."""
    moments = cells.withColumns(wind_moments(F.col(u), F.col(v)))
    out = coarsen(moments, [u, v, "wind_moment2", "wind_moment3"], window, factor)
    return out.withColumn("wind", F.sqrt("wind_moment2")).drop(f"{u}_sigma_regrid", f"{v}_sigma_regrid", "wind_moment3_sigma_regrid")
