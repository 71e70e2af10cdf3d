"""Registered queries on the given tables, each beside the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import cells as cf
from ..operators import climatology as clim
from ..operators import co2, fill, observe, quality, regrid, score, svdfill
from ..sources.readers import Entry, clip, concat, prepare, versioned
from . import products
from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CELL = ["year", "widx", "ilat", "ilon"]
#: Start, end and centre of a window in DuckDB.
S = "(make_date({y}, 1, 1) + CAST({w} * 8 AS INT))"
E_ = "least((make_date({y}, 1, 1) + CAST({w} * 8 AS INT) + 8), make_date({y} + 1, 1, 1))"
C = "(CAST({s} AS TIMESTAMP) + ({e} - {s}) * INTERVAL 12 HOUR)"


def start(y: str = "year", w: str = "widx") -> str:
    return S.format(y=y, w=w)


def end(y: str = "year", w: str = "widx") -> str:
    return E_.format(y=y, w=w)


def center(y: str = "year", w: str = "widx") -> str:
    return C.format(s=start(y, w), e=end(y, w))


def query(sql: str | None, *views: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(sql, *views)
        return f

    return add


def r6(*names: str) -> dict:
    return {n: F.round(n, 6) for n in names}


# --- calendar --------------------------------------------------------------------------------------------------------


@query(f"""WITH y AS (SELECT DISTINCT year(obs_time) AS year FROM obs), w AS (SELECT CAST(year AS INT) AS year, CAST(unnest(range(46)) AS INT) AS widx FROM y)
SELECT year, widx, CAST({start()} AS TIMESTAMP) AS window_start, CAST({end()} AS TIMESTAMP) AS window_end, {center()} AS window_center FROM w""")
def t1_windows(spark, sf_dir):
    years = view(spark, sf_dir, "obs").agg(F.min(F.year("obs_time")), F.max(F.year("obs_time"))).first()
    return cal.windows(spark, *years)


@query(f"""SELECT obs_time, CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, count(*) AS n,
{center("year(obs_time)", "floor((dayofyear(obs_time) - 1) / 8e0)")} AS window_center,
CAST({start("year(obs_time)", "floor((dayofyear(obs_time) - 1) / 8e0)")} AS TIMESTAMP) AS bound_start,
CAST({end("year(obs_time)", "floor((dayofyear(obs_time) - 1) / 8e0)")} AS TIMESTAMP) - INTERVAL 1 SECOND AS bound_end FROM obs GROUP BY obs_time""")
def t2_t3_t4_window_of_time(spark, sf_dir):
    times = cal.with_window(view(spark, sf_dir, "obs").groupBy("obs_time").count().withColumnRenamed("count", "n"), "obs_time")
    return quality.time_bounds(times.withColumn("window_center", cal.center(F.col("year"), F.col("widx"))))


@query(f"""WITH w AS (SELECT DISTINCT year, widx FROM grid8d)
SELECT year, widx, CAST(unnest(generate_series({start()}, {end()} - 1, INTERVAL 1 DAY)) AS TIMESTAMP) + INTERVAL 12 HOUR AS day FROM w""", "grid8d")
def t5_days_of_windows(spark, sf_dir):
    return cal.days(view(spark, sf_dir, "grid8d").select("year", "widx").distinct())


@query("""WITH w AS (SELECT DISTINCT year, widx FROM grid8d)
SELECT year, widx, year - CAST(widx = 0 AS INT) AS prev_year, CASE WHEN widx = 0 THEN 45 ELSE widx - 1 END AS prev_widx,
year + CAST(widx = 45 AS INT) AS next_year, CASE WHEN widx = 45 THEN 0 ELSE widx + 1 END AS next_widx FROM w""", "grid8d")
def t6_adjacent(spark, sf_dir):
    return cal.adjacent(view(spark, sf_dir, "grid8d").select("year", "widx").distinct())


@query(f"""WITH d AS (SELECT DISTINCT CAST(obs_time AS DATE) AS as_of, CAST(obs_time AS DATE) - 8 AS t FROM obs),
w AS (SELECT y AS year, w AS widx, {end("y", "w")} AS e FROM (SELECT unnest(range(1980, 2010)) AS y), (SELECT unnest(range(46)) AS w))
SELECT CAST(as_of AS TIMESTAMP) AS as_of, CAST(arg_max(year, e) AS INT) AS year, CAST(arg_max(widx, e) AS INT) AS widx FROM d JOIN w ON w.e <= d.t GROUP BY as_of""")
def t7_most_recent(spark, sf_dir):
    days = view(spark, sf_dir, "obs").select(F.col("obs_time").cast("date").cast("timestamp_ntz").alias("as_of")).distinct()
    return days.withColumn("r", cal.most_recent(F.col("as_of"))).select("as_of", "r.year", "r.widx")


@query(f"""WITH w AS (SELECT DISTINCT year, widx FROM grid8d)
SELECT year, widx, {start()} >= DATE '1996-02-01' AND {end()} <= DATE '2000-06-01' AS in_bounds,
CASE WHEN {start()} < DATE '1996-02-01' THEN 'before the start' WHEN {end()} > DATE '2000-06-01' THEN 'after the end' ELSE 'within' END AS reason,
CAST({start()} - 5 AS TIMESTAMP) AS wing_start, CAST({end()} + 4 AS TIMESTAMP) AS wing_end FROM w""", "grid8d")
def t8_t9_bounds_and_wings(spark, sf_dir):
    return cal.extended(cal.bounds_status(view(spark, sf_dir, "grid8d").select("year", "widx").distinct(), "1996-02-01", "2000-06-01"))


@query("""WITH t AS (SELECT DISTINCT epoch(time) AS t FROM wind_hourly), g AS (SELECT t, t - lag(t) OVER (ORDER BY t) AS gap FROM t)
SELECT CAST(floor(8 * 86400 / median(gap)) AS BIGINT) AS steps FROM g""", "wind_hourly")
def t10_steps_per_window(spark, sf_dir):
    return cal.steps_per_window(view(spark, sf_dir, "wind_hourly"))


@query("""WITH x AS (SELECT DISTINCT year(o_orderdate) + (dayofyear(o_orderdate) - 5e-1) / 366e0 AS x FROM orders)
SELECT round(x, 6) AS x, CAST(make_date(CAST(floor(x) AS INT), 1, 1) + CAST(floor((x - floor(x)) * 365) AS INT) AS TIMESTAMP) AS day FROM x""")
def t11_decimal_years(spark, sf_dir):
    x = F.year("o_orderdate") + (F.dayofyear("o_orderdate") - 0.5) / 366.0
    got = spark.read.parquet(f"{sf_dir}/orders.parquet").select(x.alias("x")).distinct()
    return got.select(F.round("x", 6).alias("x"), cal.decimal_year_date(F.col("x")).cast("timestamp_ntz").alias("day"))


# --- entries, projections, formulas ----------------------------------------------------------------------------------


@query("""SELECT time, ilat, ilon, v AS v_p, v_sigma_uncert AS v_p_sigma_uncert, CASE WHEN time < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS flag_p
FROM cells_daily WHERE time >= TIMESTAMP '1996-01-01' AND time <= TIMESTAMP '2000-12-31'""", "cells_daily")
def s1_p1_p6_p8_j1_entries(spark, sf_dir):
    names = {"v": "v_p", "v_sigma_uncert": "v_p_sigma_uncert"}
    cells = view(spark, sf_dir, "cells_daily").drop("flag_p")
    entries = [Entry("", names, "1996-01-01", "1997-12-31 23:59:59", 1), Entry("", names, "1998-01-01", "2000-12-31", 2)]
    return concat(prepare(cells, e, "p", ["time", "ilat", "ilon"]) for e in entries)


@query("""SELECT time, ilat, ilon, u10, time >= TIMESTAMP '2024-01-20' AS is_nrt FROM wind_hourly WHERE time >= TIMESTAMP '2024-01-05'""", "wind_hourly")
def s2_p9_nrt_flag(spark, sf_dir):
    cells = view(spark, sf_dir, "wind_hourly").withColumn("time", F.col("time").cast("timestamp_ntz"))
    return prepare(cells, Entry("", {"u10": "u10"}, "2024-01-05"), "wind", ["time", "ilat", "ilon"], nrt_from="2024-01-20")


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT CAST(date AS TIMESTAMP) AS date, CASE WHEN date <= DATE '1997-06-30' THEN 'A' ELSE 'B' END AS name,
concat('/data/', CASE WHEN date <= DATE '1997-06-30' THEN 'A' ELSE 'B' END, '/', strftime(date, '%Y%m%d'), '.parquet') AS path FROM d""")
def s4_versioned_paths(spark, sf_dir):
    dates = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    versions = spark.sql("SELECT 'A' AS name, DATE '1970-01-01' AS time_start, DATE '1997-06-30' AS time_end UNION ALL SELECT 'B', DATE '1997-07-01', NULL")
    got = versioned(dates, versions, "/data/%2$s/%1$s.parquet")
    return got.select(F.col("date").cast("timestamp_ntz").alias("date"), "name", "path")


@query("""SELECT lon10_raw, round(((lon10_raw + 5e-1) / 1e1 + 180) % 360 - 180, 6) AS lon180, count(*) AS n,
CAST(floor((((lon10_raw + 5e-1) / 1e1 + 180) % 360) / 10) AS INT) AS ilon FROM obs GROUP BY lon10_raw""")
def p2_wrapped_longitude(spark, sf_dir):
    got = view(spark, sf_dir, "obs").groupBy("lon10_raw", "lon").agg(F.count("*").alias("n"))
    return got.select("lon10_raw", F.round(cf.wrapped(F.col("lon")), 6).alias("lon180"), "n", cf.lon_index(F.col("lon"), 10.0).alias("ilon"))


@query("""WITH r AS (SELECT o_orderdate AS time, round(o_custkey % 90 + 1e-4, 3) AS lat, round(o_custkey % 180 - 1e-4, 3) AS lon, o_orderkey AS v, o_orderkey FROM orders),
f AS (SELECT *, row_number() OVER (PARTITION BY time, lat, lon ORDER BY o_orderkey) AS k FROM r) SELECT time, lat, lon, v FROM f WHERE k = 1""")
def p3_first_by_coordinates(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select(F.col("o_orderdate").alias("time"), (F.col("o_custkey") % 90 + 1e-4).alias("lat"), (F.col("o_custkey") % 180 - 1e-4).alias("lon"), F.col("o_orderkey").alias("v"))
    return cf.first_by_coordinates(rows, "time", "v")


@query("""WITH d AS (SELECT obs_time AS time, lat10, max(fco2) AS v, CAST(sst_sigma_uncert AS DOUBLE) AS depth FROM obs GROUP BY 1, 2, 4)
SELECT time, lat10, arg_min(v, depth) AS v FROM d GROUP BY 1, 2""")
def p4_surface_level(spark, sf_dir):
    deep = view(spark, sf_dir, "obs").groupBy(F.col("obs_time").alias("time"), "lat10", F.col("sst_sigma_uncert").alias("depth")).agg(F.max("fco2").alias("v"))
    return cf.level(deep, ["time", "lat10"], "depth", ["v"])


@query("""SELECT obs_time AS time, lat, CAST(fco2 AS FLOAT) AS fco2, qc_flag, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4""")
def p5_p7_squeeze_and_cast(spark, sf_dir):
    o = view(spark, sf_dir, "obs").select(F.col("obs_time").alias("time"), "lat", F.lit(0).alias("depth"), "qc_flag", F.col("fco2").cast("float").alias("fco2"))
    return cf.squeezed(o, ["time", "lat", "depth", "qc_flag"]).groupBy("time", "lat", "fco2", "qc_flag").agg(F.count("*").alias("n"))


@query("""SELECT time, ilat, ilon, u10 * u10 + v10 * v10 AS wind_moment2, round((u10 * u10 * u10 + v10 * v10 * v10) / 1e9, 3) AS moment3_e9,
round(sqrt(u10 * u10 + v10 * v10), 6) AS wind FROM wind_hourly""", "wind_hourly")
def p10_p11_wind(spark, sf_dir):
    w = view(spark, sf_dir, "wind_hourly").withColumns(cf.wind_moments(F.col("u10"), F.col("v10")))
    return w.select(F.col("time").cast("timestamp_ntz").alias("time"), "ilat", "ilon", "wind_moment2", F.round(F.col("wind_moment3") / 1e9, 3).alias("moment3_e9"), F.round(F.sqrt("wind_moment2"), 6).alias("wind"))


@query("""SELECT year, widx, ilat, ilon, round(CASE WHEN v IS NOT NULL THEN log10(greatest(v / 1e4, 5e-3)) END, 6) AS chl FROM grid8d""", "grid8d")
def p12_log_chlorophyll(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d").withColumn("chl", F.col("v") / 1e4)
    out = g if fill.log_state(g, "chl") else g.withColumn("chl", cf.log10_clipped(F.col("chl")))
    return out.select(*CELL, F.round("chl", 6).alias("chl"))


@query("""WITH c AS (SELECT year, widx, ilat, 3.5e2 + v / 1e1 AS x, ilat * 5e0 AS t, 1e5 + n AS p, 3e1 + ilon / 4e0 AS s, ilon FROM grid8d),
k AS (SELECT *, t + 273.15 AS k, 31.998 * s / (1e3 - 1.005 * s) AS m FROM c), z AS (SELECT *, 1 - k / 647.096 AS z, m * 5e-1 AS h FROM k),
w AS (SELECT *, exp(647.096 / k * (-7.85951783 * z + 1.84408259 * pow(z, 1.5) - 11.7866497 * pow(z, 3) + 22.6807411 * pow(z, 3.5) - 15.9618719 * pow(z, 4) + 1.80122502 * pow(z, 7.5)))
 * 22.064 / 0.101325 * exp(-0.018 * m * (0.90799 - 0.08992 * h + 0.18458 * h * h - 0.07395 * pow(h, 3) - 0.00221 * pow(h, 4))) AS vp FROM z)
SELECT year, widx, ilat, ilon, round(x * (p / 101325 - vp) * exp(((-1636.75 + 12.0408 * k - 0.0327957 * k * k + 3.16528e-5 * pow(k, 3)) + 2 * pow(1 - x * 1e-6, 2) * (57.7 - 0.118 * k)) * p / 101325 / (82.05736 * k)), 5) AS fco2 FROM w""", "grid8d")
def p13_e5_j7_fugacity(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d")
    return g.select(*CELL, F.round(cf.fugacity(350 + F.col("v") / 10, F.col("ilat") * 5.0, 1e5 + F.col("n"), 30 + F.col("ilon") / 4), 5).alias("fco2"))


# --- regridding ------------------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT DISTINCT ilat FROM (SELECT unnest(range(18)) AS ilat)), o AS (SELECT unnest(range(36)) AS ilon), n AS (SELECT ilat, ilon, count(*) AS n FROM cells_daily GROUP BY 1, 2)
SELECT CAST(c.ilat AS INT) AS ilat, CAST(o.ilon AS INT) AS ilon, (c.ilat + 5e-1) * 10 - 90 AS lat, (o.ilon + 5e-1) * 10 - 180 AS lon, coalesce(n.n, 0) AS n
FROM c CROSS JOIN o LEFT JOIN n ON n.ilat = c.ilat AND n.ilon = o.ilon""", "cells_daily")
def g1_target_grid(spark, sf_dir):
    n = view(spark, sf_dir, "cells_daily").groupBy("ilat", "ilon").agg(F.count("*").alias("n"))
    return regrid.target_grid(spark, 10.0).join(n, ["ilat", "ilon"], "left").na.fill(0, ["n"])


@query("""WITH e AS (SELECT 'lat' AS axis, CAST(unnest(range(19)) AS INT) AS i UNION ALL SELECT 'lon', CAST(unnest(range(37)) AS INT)),
n AS (SELECT 'lat' AS axis, ilat AS i, count(*) AS n FROM cells_daily GROUP BY 2 UNION ALL SELECT 'lon', ilon, count(*) FROM cells_daily GROUP BY 2)
SELECT axis, i, CASE WHEN axis = 'lat' THEN i * 1e1 - 90 ELSE i * 1e1 - 180 END AS edge, coalesce(n, 0) AS n FROM e LEFT JOIN n USING (axis, i)""", "cells_daily")
def g2_grid_edges(spark, sf_dir):
    c = view(spark, sf_dir, "cells_daily")
    n = c.groupBy(F.lit("lat").alias("axis"), F.col("ilat").alias("i")).agg(F.count("*").alias("n")).union(c.groupBy(F.lit("lon").alias("axis"), F.col("ilon").alias("i")).agg(F.count("*")))
    return regrid.grid_edges(spark, 10.0).join(n, ["axis", "i"], "left").na.fill(0, ["n"])


W = "CAST(year(time) AS INT) AS year, CAST(floor((dayofyear(time) - 1) / 8e0) AS INT) AS widx"


@query(f"""SELECT {W}, CAST(floor(ilat / 3e0) AS INT) AS ilat, CAST(floor(ilon / 3e0) AS INT) AS ilon, round(avg(v), 6) AS v, round(avg(v_sigma_uncert), 6) AS v_sigma_uncert,
round(avg(flag_p), 6) AS flag_p, round(stddev_pop(v), 6) AS v_sigma_regrid FROM cells_daily GROUP BY 1, 2, 3, 4""", "cells_daily")
def g3_p14_coarsen(spark, sf_dir):
    out = regrid.coarsen(cal.with_window(view(spark, sf_dir, "cells_daily"), "time"), ["v", "v_sigma_uncert", "flag_p"], ["year", "widx"], 3)
    return out.withColumns(r6("v", "v_sigma_uncert", "flag_p", "v_sigma_regrid"))


def axis_sql(n: int, m: int, extent: float, i: str) -> str:
    """Weights of one axis in SQL: two rows for each target between the source's first and last centre."""
    return f"""SELECT CAST(s.s AS INT) AS {i}, CAST(t.t AS INT) AS j{i[1:]}, 1 - abs((t.t + 5e-1) * {extent / m!r} - (s.s + 5e-1) * {extent / n!r}) / {extent / n!r} AS w{i[1:]}
FROM (SELECT unnest(range({n})) AS s) s JOIN (SELECT unnest(range({m})) AS t) t ON abs((t.t + 5e-1) * {extent / m!r} - (s.s + 5e-1) * {extent / n!r}) < {extent / n!r}
WHERE (t.t + 5e-1) * {extent / m!r} BETWEEN {extent / n / 2!r} AND {extent - extent / n / 2!r}"""


@query(f"""WITH a AS ({axis_sql(6, 9, 180.0, "ilat")}), o AS ({axis_sql(12, 18, 360.0, "ilon")})
SELECT year, widx, jlat AS ilat, jlon AS ilon, round(CASE WHEN sum(wlat * wlon) > 1 - 1e-9 THEN sum(wlat * wlon * v) END, 6) AS v
FROM grid8d JOIN a USING (ilat) JOIN o USING (ilon) GROUP BY 1, 2, 3, 4""", "grid8d")
def g4_interpolate(spark, sf_dir):
    axes = []
    for n, m, extent, a in ((6, 9, 180.0, "lat"), (12, 18, 360.0, "lon")):
        axes.append(regrid.linear_weights(spark, [(i + 0.5) * extent / n for i in range(n)], [(i + 0.5) * extent / m for i in range(m)], f"i{a}", f"j{a}", f"w{a}"))
    return regrid.interpolate(view(spark, sf_dir, "grid8d"), ["v"], ["year", "widx"], *axes).withColumns(r6("v"))


@query(f"""WITH c AS (SELECT {W}, CAST(floor(ilat / 3e0) AS INT) AS ilat, CAST(floor(ilon / 3e0) AS INT) AS ilon, avg(v) AS v FROM cells_daily GROUP BY 1, 2, 3, 4),
a AS ({axis_sql(6, 9, 180.0, "ilat")}), o AS ({axis_sql(12, 18, 360.0, "ilon")}),
g AS (SELECT year, widx, jlat AS ilat, jlon AS ilon, CASE WHEN sum(wlat * wlon) > 1 - 1e-9 THEN sum(wlat * wlon * v) END AS v FROM c JOIN a USING (ilat) JOIN o USING (ilon) GROUP BY 1, 2, 3, 4)
SELECT year, widx, ilat, ilon, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 2) AS v, {center()} AS window_center FROM g""", "cells_daily")
def g5_g6_regrid(spark, sf_dir):
    out = regrid.regrid(cal.with_window(view(spark, sf_dir, "cells_daily"), "time"), ["v"], ["year", "widx"], 3, 10.0, 20.0)
    return out.select(*CELL, F.round(F.col("v").cast("double"), 2).alias("v"), cal.center(F.col("year"), F.col("widx")).alias("window_center"))


@query(f"""SELECT {W}, CAST(floor(ilat / 2e0) AS INT) AS ilat, CAST(floor(ilon / 2e0) AS INT) AS ilon, round(avg(u10), 6) AS u10, round(avg(v10), 6) AS v10,
round(avg(u10 * u10 + v10 * v10), 3) AS wind_moment2, round(stddev_pop(u10 * u10 + v10 * v10), 3) AS wind_moment2_sigma_regrid, round(sqrt(avg(u10 * u10 + v10 * v10)), 6) AS wind
FROM wind_hourly GROUP BY 1, 2, 3, 4""", "wind_hourly")
def g7_hourly_wind(spark, sf_dir):
    out = regrid.hourly_wind(cal.with_window(view(spark, sf_dir, "wind_hourly"), "time"), ["year", "widx"], 2)
    return out.drop("wind_moment3").withColumns(r6("u10", "v10", "wind") | {n: F.round(n, 3) for n in ("wind_moment2", "wind_moment2_sigma_regrid")})


@query("""WITH f AS (SELECT (year - 1990) * 46 * 5 + widx * 5 AS day, ilat, ilon, v FROM grid8d), t AS (SELECT DISTINCT day FROM f),
p AS (SELECT day AS t0, lead(day) OVER (ORDER BY day) AS t1 FROM t), d AS (SELECT unnest(range(t0, coalesce(t1, t0 + 1))) AS d, t0, t1 FROM p),
w AS (SELECT d, t0 AS day, 1 - CASE WHEN t1 IS NULL THEN 0 ELSE (d - t0) / CAST(t1 - t0 AS DOUBLE) END AS w FROM d UNION ALL SELECT d, t1, (d - t0) / CAST(t1 - t0 AS DOUBLE) FROM d WHERE d > t0)
SELECT ilat, ilon, CAST(d AS INT) AS day, round(CASE WHEN sum(w) > 1 - 1e-9 THEN sum(w * v) END, 6) AS v FROM f JOIN w USING (day) GROUP BY 1, 2, 3""", "grid8d")
def g8a_daily(spark, sf_dir):
    f = view(spark, sf_dir, "grid8d").select(((F.col("year") - 1990) * 230 + F.col("widx") * 5).alias("day"), "ilat", "ilon", "v")
    return regrid.to_daily(f, "v").withColumns(r6("v"))


@query(f"""SELECT {W}, ilat, ilon, round(avg(v), 6) AS v, count(*) AS n FROM cells_daily GROUP BY 1, 2, 3, 4""", "cells_daily")
def g8b_window_mean(spark, sf_dir):
    return cal.with_window(view(spark, sf_dir, "cells_daily"), "time").groupBy(*CELL).agg(F.round(F.avg("v"), 6).alias("v"), F.count("*").alias("n"))


@query("""WITH m AS (SELECT CAST(t AS INT) AS ilat, CAST(floor((t * 20 + 10 - 15) / 3e1 + 5e-1) AS INT) AS s FROM (SELECT unnest(range(9)) AS t))
SELECT year, widx, m.ilat, ilon, v FROM grid8d g JOIN m ON m.s = g.ilat WHERE abs(m.ilat * 20 + 10 - (m.s * 30 + 15)) <= 5""", "grid8d")
def g8c_j3_nearest(spark, sf_dir):
    near = regrid.nearest_table(spark, [i * 30.0 + 15 for i in range(6)], [i * 20.0 + 10 for i in range(9)], 5.0)
    g = view(spark, sf_dir, "grid8d").withColumnRenamed("ilat", "src")
    return g.join(F.broadcast(near), "src").select("year", "widx", F.col("dst").alias("ilat"), "ilon", "v")


#: Cells of every longitude in the windows and rows that occur, some without a value, in SQL and below in DataFrames.
GAPPED = """k AS (SELECT DISTINCT year, widx, ilat FROM grid8d), s AS (SELECT year, widx, ilat, CAST(o AS INT) AS ilon FROM k CROSS JOIN (SELECT unnest(range(12)) AS o)),
g AS (SELECT s.*, CASE WHEN {gap} THEN NULL ELSE v END AS v, (s.ilon + 6) % 12 AS o FROM s LEFT JOIN grid8d USING (year, widx, ilat, ilon)),
b AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS a, last_value(CASE WHEN v IS NOT NULL THEN o END IGNORE NULLS) OVER p AS ia,
 first_value(v IGNORE NULLS) OVER f AS z, first_value(CASE WHEN v IS NOT NULL THEN o END IGNORE NULLS) OVER f AS iz, count(v) OVER (PARTITION BY year, widx, ilon) AS c FROM g
 WINDOW p AS (PARTITION BY year, widx, ilat ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY year, widx, ilat ORDER BY o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def gapped(spark, sf_dir, gap):
    g = view(spark, sf_dir, "grid8d").select(*CELL, "v")
    rows = g.select("year", "widx", "ilat").distinct().withColumn("ilon", F.explode(F.sequence(F.lit(0), F.lit(11))))
    return rows.join(g, CELL, "left").withColumn("v", F.when(~gap, F.col("v")))


@query(f"""WITH {GAPPED.format(gap="(widx + s.ilon) % 5 < 2")} SELECT year, widx, ilat, ilon,
round(coalesce(v, CASE WHEN iz > ia AND o - ia <= 2 THEN a + (z - a) * (o - ia) / CAST(iz - ia AS DOUBLE) END), 6) AS v FROM b""", "grid8d")
def g8d_fill_lon_limited(spark, sf_dir):
    return regrid.fill_lon_limited(gapped(spark, sf_dir, (F.col("widx") + F.col("ilon")) % 5 < 2), "v", ["year", "widx"], 12).withColumns(r6("v"))


@query(f"""WITH {GAPPED.format(gap="widx % 5 = 0 AND s.ilon IN (0, 11)")} SELECT year, widx, ilat, ilon,
round(CASE WHEN c > 0 THEN v WHEN iz > ia THEN a + (z - a) * (o - ia) / CAST(iz - ia AS DOUBLE) END, 6) AS v FROM b""", "grid8d")
def g9_fill_lon_gap(spark, sf_dir):
    return regrid.fill_lon_gap(gapped(spark, sf_dir, (F.col("widx") % 5 == 0) & F.col("ilon").isin(0, 11)), "v", ["year", "widx"], 12).withColumns(r6("v"))


# --- merging and filling ---------------------------------------------------------------------------------------------


@query("SELECT coalesce(g.year, b.year) AS year, coalesce(g.widx, b.widx) AS widx, coalesce(g.ilat, b.ilat) AS ilat, coalesce(g.ilon, b.ilon) AS ilon, v, n, v_b FROM grid8d g FULL JOIN product_b b ON g.year = b.year AND g.widx = b.widx AND g.ilat = b.ilat AND g.ilon = b.ilon", "grid8d", "product_b")
def j2_b2_merge_products(spark, sf_dir):
    return products.catalog_windows([view(spark, sf_dir, "grid8d").drop("v_sd"), view(spark, sf_dir, "product_b")])


@query("""WITH m AS (SELECT coalesce(g.year, b.year) AS year, coalesce(g.widx, b.widx) AS widx, coalesce(g.ilat, b.ilat) AS ilat, coalesce(g.ilon, b.ilon) AS ilon, CASE WHEN n > 2 THEN v END AS a, v AS c, v_b
FROM grid8d g FULL JOIN product_b b ON g.year = b.year AND g.widx = b.widx AND g.ilat = b.ilat AND g.ilon = b.ilon)
SELECT year, widx, ilat, ilon, coalesce(a, v_b, c) AS filled, CASE WHEN a IS NOT NULL THEN 1 WHEN v_b IS NOT NULL THEN 2 WHEN c IS NOT NULL THEN 3 ELSE 0 END AS flag,
coalesce(a, v_b) AS two, CASE WHEN a IS NOT NULL THEN 1 WHEN v_b IS NOT NULL THEN 2 ELSE 0 END AS two_flag FROM m""", "grid8d", "product_b")
def f1_f2_fill_by_sources(spark, sf_dir):
    both = products.catalog_windows([view(spark, sf_dir, "grid8d").select(*CELL, F.when(F.col("n") > 2, F.col("v")).alias("a"), F.col("v").alias("c")), view(spark, sf_dir, "product_b")])
    return fill.fill_with_flag(fill.fill_successively(both, ["a", "v_b", "c"], "filled", "flag"), "a", "v_b", "two", "two_flag").select(*CELL, "filled", "flag", "two", "two_flag")


def step_sql(source: str, part: str, order: str) -> str:
    one = f"SELECT year, widx, ilat, ilon, coalesce(v, lag(v) OVER (PARTITION BY {part} ORDER BY {order})) AS v FROM {source}"
    return f"SELECT year, widx, ilat, ilon, coalesce(v, lead(v) OVER (PARTITION BY {part} ORDER BY {order})) AS v FROM ({one})"


@query(f"""WITH s AS (SELECT t.year, t.widx, c.ilat, c.ilon, CASE WHEN n > 1 THEN v END AS v FROM (SELECT DISTINCT year, widx FROM grid8d) t CROSS JOIN (SELECT DISTINCT ilat, ilon FROM grid8d) c LEFT JOIN grid8d USING (year, widx, ilat, ilon)),
a AS ({step_sql("s", "ilat, ilon", "year, widx")}), b AS ({step_sql("a", "year, widx, ilon", "ilat")}), c AS ({step_sql("b", "year, widx, ilat", "ilon")}) SELECT * FROM c""", "grid8d")
def w4_f3_fill_nearest(spark, sf_dir):
    g = fill.dense(view(spark, sf_dir, "grid8d").select(*CELL, F.when(F.col("n") > 1, F.col("v")).alias("v")), ["year", "widx"], ["ilat", "ilon"])
    return fill.fill_nearest(g, "v", [(["ilat", "ilon"], ["year", "widx"]), (["year", "widx", "ilon"], ["ilat"]), (["year", "widx", "ilat"], ["ilon"])]).select(*CELL, "v")


@query("""WITH n AS (SELECT d, x, row_number() OVER (ORDER BY d) AS i FROM series), b AS (SELECT *, last_value(x IGNORE NULLS) OVER p AS a, last_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER p AS ia,
first_value(x IGNORE NULLS) OVER f AS z, first_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER f AS iz FROM n
WINDOW p AS (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT CAST(d AS TIMESTAMP) AS d, round(coalesce(x, CASE WHEN iz > ia THEN a + (z - a) * (i - ia) / CAST(iz - ia AS DOUBLE) END, a), 4) AS x FROM b""", "series")
def w5_interpolate_positions(spark, sf_dir):
    return fill.interpolate_positions(view(spark, sf_dir, "series"), "x", "d").select(F.col("d").cast("timestamp_ntz").alias("d"), F.round("x", 4).alias("x"))


@query(None)
def f4_f5_svd_fill(spark, sf_dir):
    """Chlorophyll filling year by year: original, nearest along time, latitude and longitude, reconstructed from the climatology as first guess."""
    g = fill.dense(view(spark, sf_dir, "grid8d").select(*CELL, F.when((F.col("n") > 1), F.col("v") / 100).alias("chl")), ["year", "widx"], ["ilat", "ilon"])
    season = clim.climatology(g, ["chl"], "widx").withColumnRenamed("season_key", "widx")
    return svdfill.filled_by_year(g, season, "chl", "clim_chl").withColumn("chl_filled", F.round("chl_filled", 6))


@query(None)
def f5_p12_chlorophyll_log10(spark, sf_dir):
    """The same as one operator: whole years, brought to log10, against a climatology of the same shape."""
    g = view(spark, sf_dir, "grid8d").select(*CELL, F.when(F.col("n") > 1, F.col("v") / 100).alias("chl"))
    years = g.select("year").distinct()  # a row for each
    places = g.select("ilat", "ilon").distinct().withColumn("widx", F.explode(F.sequence(F.lit(0), F.lit(45))))
    whole = places.join(F.broadcast(years), F.lit(True)).join(g, CELL, "left")
    season = clim.climatology(whole.withColumn("chl", cf.log10_clipped(F.col("chl"))), ["chl"], "widx").withColumnRenamed("season_key", "widx")
    return svdfill.fill_chlorophyll(whole, season, convert=True).withColumn("chl_filled", F.round("chl_filled", 6))


# --- observations ----------------------------------------------------------------------------------------------------


@query("""SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 1e2) AS INT) AS ilat, CAST(floor(lon10 / 1e2) AS INT) AS ilon,
avg(fco2) AS fco2_mean, round(stddev_pop(fco2), 6) AS fco2_std, avg(sst) AS sst_mean, round(stddev_pop(sst), 4) AS sst_std, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4""")
def a6_gridded_observations(spark, sf_dir):
    out = observe.grid(view(spark, sf_dir, "obs"), ["fco2", "sst"], 10.0)
    return out.withColumns({"fco2_std": F.round("fco2_std", 6), "sst_std": F.round("sst_std", 4)})


@query("""SELECT expocode, CAST(dense_rank() OVER (ORDER BY expocode) - 1 AS INT) AS expocode_idx, qc_flag, CAST(dense_rank() OVER (ORDER BY qc_flag) - 1 AS INT) AS qc_flag_idx, n FROM (SELECT expocode, qc_flag, count(*) AS n FROM obs GROUP BY 1, 2)""")
def a7_category_codes(spark, sf_dir):
    return observe.with_codes(view(spark, sf_dir, "obs").groupBy("expocode", "qc_flag").agg(F.count("*").alias("n")), ["expocode", "qc_flag"])


@query("""SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 5e1) AS INT) AS ilat, CAST(floor(lon10 / 5e1) AS INT) AS ilon, count(*) AS n, count(DISTINCT expocode) AS ships FROM obs GROUP BY 1, 2, 3, 4""")
def j4_points_to_bins(spark, sf_dir):
    return observe.with_cells(view(spark, sf_dir, "obs"), 5.0).groupBy(*CELL).agg(F.count("*").alias("n"), F.count_distinct("expocode").alias("ships"))


@query("""SELECT year, widx, ilat, count(*) AS cells, count(CASE WHEN ilon % 3 > 0 THEN v END) AS values FROM grid8d GROUP BY 1, 2, 3""", "grid8d")
def a8_counts(spark, sf_dir):
    return view(spark, sf_dir, "grid8d").groupBy("year", "widx", "ilat").agg(F.count("*").alias("cells"), F.count(F.when(F.col("ilon") % 3 > 0, F.col("v"))).alias("values"))


@query("""SELECT CAST(year(obs_time) AS INT) AS year, count(DISTINCT obs_time) AS times, count(DISTINCT floor((dayofyear(obs_time) - 1) / 8e0)) AS windows FROM obs GROUP BY 1""")
def a9_distinct_times(spark, sf_dir):
    o = cal.with_window(view(spark, sf_dir, "obs"), "obs_time")
    return o.groupBy("year").agg(F.count_distinct("obs_time").alias("times"), F.count_distinct("widx").alias("windows"))


# --- climatology and features ----------------------------------------------------------------------------------------


@query(f"""SELECT ilat, ilon, CAST(dayofyear({center()}) AS INT) AS season_key, round(avg(v), 6) AS clim_v FROM grid8d GROUP BY 1, 2, 3""", "grid8d")
def a1_climatology(spark, sf_dir):
    return clim.climatology(view(spark, sf_dir, "grid8d"), ["v"]).withColumns(r6("clim_v"))


@query("SELECT ilat, ilon, round(avg(v), 6) AS ltm_v FROM grid8d GROUP BY 1, 2", "grid8d")
def a2_long_term_mean(spark, sf_dir):
    return clim.long_term_mean(view(spark, sf_dir, "grid8d"), ["v"]).withColumns(r6("ltm_v"))


@query("""WITH c AS (SELECT ilat, ilon, widx AS season_key, avg(v) AS c FROM grid8d GROUP BY 1, 2, 3), l AS (SELECT ilat, ilon, avg(v) AS l FROM grid8d GROUP BY 1, 2)
SELECT ilat, ilon, season_key, round(c - l, 6) AS seas_v FROM c JOIN l USING (ilat, ilon)""", "grid8d")
def e1_j8_seasonal_anomaly(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d")
    return clim.seasonal_anomaly(clim.climatology(g, ["v"], "widx"), clim.long_term_mean(g, ["v"]), ["v"]).withColumns(r6("seas_v"))


FEATURES = """f AS (SELECT year, widx, ilat, ilon, v - avg(v) OVER (PARTITION BY ilat, ilon, widx) AS anom_v,
CASE WHEN (year * 46 + widx) - lag(year * 46 + widx) OVER w = 1 THEN v - lag(v) OVER w END AS delta_v, avg(v) OVER (PARTITION BY ilat, ilon, widx) AS clim_v,
avg(v) OVER (PARTITION BY ilat, ilon, widx) - avg(v) OVER (PARTITION BY ilat, ilon) AS seas_v FROM grid8d WINDOW w AS (PARTITION BY ilat, ilon ORDER BY year, widx))"""
FEATURE_COLUMNS = "round(anom_v, 6) AS anom_v, round(delta_v, 6) AS delta_v, round(clim_v, 6) AS clim_v, round(seas_v, 6) AS seas_v"


@query(f"WITH {FEATURES} SELECT year, widx, ilat, ilon, {FEATURE_COLUMNS} FROM f", "grid8d")
def e2_e3_w3_features(spark, sf_dir):
    return clim.features(view(spark, sf_dir, "grid8d"), ["v"]).withColumns(r6("anom_v", "delta_v", "clim_v", "seas_v"))


@query(f"""WITH {FEATURES}, o AS (SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 3e2) AS INT) AS ilat, CAST(floor(lon10 / 3e2) AS INT) AS ilon,
avg(sst) AS sst_mean, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4) SELECT year, widx, ilat, ilon, sst_mean, n, {FEATURE_COLUMNS} FROM o JOIN f USING (year, widx, ilat, ilon)""", "grid8d")
def j9_b4_training_table(spark, sf_dir):
    seen = observe.grid(view(spark, sf_dir, "obs"), ["sst"], 30.0).drop("sst_std")
    return products.training_table(seen, view(spark, sf_dir, "grid8d"), ["v"]).withColumns(r6("anom_v", "delta_v", "clim_v", "seas_v"))


def smooth_sql(source: str, part: str, order: str, times: int) -> str:
    for _ in range(times):
        source = f"(SELECT * REPLACE (avg(v) OVER ({part} ORDER BY {order} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v) FROM {source})"
    return source


@query(f"SELECT year, widx, ilat, ilon, round(v, 6) AS v FROM {smooth_sql('(SELECT year, widx, ilat, ilon, v FROM grid8d)', 'PARTITION BY ilat, ilon', 'year, widx', 3)}", "grid8d")
def w1_smooth(spark, sf_dir):
    return clim.smooth(view(spark, sf_dir, "grid8d").select(*CELL, "v"), "v", ["ilat", "ilon"], ["year", "widx"], 3, 3).withColumns(r6("v"))


@query(f"""WITH c AS (SELECT ilat, ilon, widx, avg(v) AS v FROM grid8d GROUP BY 1, 2, 3), t AS (SELECT c.*, k FROM c CROSS JOIN (SELECT unnest(range(3)) AS k))
SELECT ilat, ilon, widx AS season_key, round(v, 6) AS clim_v FROM {smooth_sql("t", "PARTITION BY ilat, ilon", "k, widx", 2)} WHERE k = 1""", "grid8d")
def w2_smooth_cycle(spark, sf_dir):
    c = clim.climatology(view(spark, sf_dir, "grid8d"), ["v"], "widx")
    return clim.smooth_cycle(c, "clim_v", ["ilat", "ilon"], "season_key", 3, 2).withColumns(r6("clim_v"))


# --- the CO2 field ---------------------------------------------------------------------------------------------------

STATION = """st AS (SELECT CAST(year(d) AS INT) AS year, CAST(floor((dayofyear(d) - 1) / 8e0) AS INT) AS widx, avg(x) AS x FROM series GROUP BY 1, 2)"""


def station(spark, sf_dir):
    s = cal.with_window(view(spark, sf_dir, "series"), "d")
    return s.groupBy("year", "widx").agg(F.avg("x").alias("x"))


@query(f"""WITH {STATION}, b AS (SELECT st.*, l.ilat, l.y FROM st JOIN lat_series l USING (year, widx)), s AS (SELECT ilat, regr_slope(y, x) AS slope, avg(y) AS my, avg(x) AS mx FROM b GROUP BY 1)
SELECT ilat, round(slope, 8) AS slope, round(my - slope * mx, 3) AS intercept FROM s""", "series", "lat_series")
def a3_regression(spark, sf_dir):
    both = station(spark, sf_dir).join(view(spark, sf_dir, "lat_series"), ["year", "widx"])
    return co2.regress(both, "x", "y", ["ilat"]).select("ilat", F.round("slope", 8).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query("""WITH r AS (SELECT ilat, widx, y - avg(y) OVER (PARTITION BY ilat) AS v FROM lat_series), c AS (SELECT ilat, widx, avg(v) AS v FROM r GROUP BY 1, 2), t AS (SELECT c.*, k FROM c CROSS JOIN (SELECT unnest(range(3)) AS k))
SELECT ilat, widx, round(v, 4) AS cycle FROM """ + smooth_sql("t", "PARTITION BY ilat", "k, widx", 1) + " WHERE k = 1", "lat_series")
def a4_residual_cycle(spark, sf_dir):
    y = view(spark, sf_dir, "lat_series")
    r = y.join(y.groupBy("ilat").agg(F.avg("y").alias("m")), "ilat").withColumn("r", F.col("y") - F.col("m"))
    return co2.residual_cycle(r, "r", ["ilat"], "widx").withColumn("cycle", F.round("cycle", 4))


@query("""SELECT grp, round(1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true), 6) AS r2, round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 4) AS rmse, round(avg(abs(y_true - y_pred)), 4) AS mae, count(*) AS n
FROM pairs WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1""", "pairs")
def a5_fit_metrics(spark, sf_dir):
    return score.fit_metrics(view(spark, sf_dir, "pairs"), "y_true", "y_pred", ["grp"]).withColumns({"r2": F.round("r2", 6), "rmse": F.round("rmse", 4), "mae": F.round("mae", 4)})


@query(f"""WITH k AS (SELECT epoch(CAST(d AS TIMESTAMP)) AS t, x FROM series WHERE x IS NOT NULL), q AS (SELECT DISTINCT year, widx, epoch({center()}) AS t FROM grid8d),
p AS (SELECT q.*, (SELECT max(t) FROM k WHERE k.t <= q.t) AS ta, (SELECT min(t) FROM k WHERE k.t >= q.t) AS tb FROM q)
SELECT CAST(p.t AS BIGINT) AS t, round(CASE WHEN ta = tb THEN a.x ELSE a.x + (b.x - a.x) * (p.t - ta) / (tb - ta) END, 4) AS x FROM p LEFT JOIN k a ON a.t = p.ta LEFT JOIN k b ON b.t = p.tb""", "series", "grid8d")
def j5_series_at_centers(spark, sf_dir):
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    knots = view(spark, sf_dir, "series").select(seconds(F.col("d")).alias("t"), "x")
    asked = view(spark, sf_dir, "grid8d").select("year", "widx").distinct().select(seconds(cal.center(F.col("year"), F.col("widx"))).alias("t"))
    return co2.at_times(knots, asked, "t", "x").withColumn("x", F.round("x", 4))


@query(f"""WITH a AS ({axis_sql(6, 18, 180.0, "ilat")}) SELECT year, widx, jlat AS ilat, round(CASE WHEN sum(wlat) > 1 - 1e-9 THEN sum(wlat * y) END, 3) AS y FROM lat_series JOIN a USING (ilat) GROUP BY 1, 2, 3""", "lat_series")
def j6_interpolate_latitude(spark, sf_dir):
    w = regrid.linear_weights(spark, [(i + 0.5) * 30 for i in range(6)], [(i + 0.5) * 10 for i in range(18)], "ilat", "jlat", "wlat")
    one = spark.createDataFrame([(0, 0, 1.0)], "ilon int, jlon int, wlon double")
    out = regrid.interpolate(view(spark, sf_dir, "lat_series").withColumn("ilon", F.lit(0)), ["y"], ["year", "widx"], w, one)
    return out.select("year", "widx", "ilat", F.round("y", 3).alias("y"))


@query("""WITH b AS (SELECT t.year, t.widx, l.ilat, y, 1e5 + t.widx * 1e2 AS f, t.year * 100 + t.widx AS t FROM (SELECT DISTINCT year, widx FROM grid8d) t CROSS JOIN (SELECT DISTINCT ilat FROM lat_series) l LEFT JOIN lat_series USING (year, widx, ilat)),
z AS (SELECT max(t) AS t FROM (SELECT t FROM b GROUP BY t HAVING count(y) = count(*))), s AS (SELECT ilat, y - f AS shift FROM b WHERE t = (SELECT t FROM z))
SELECT year, widx, ilat, round(f + coalesce(shift, 0), 3) AS f FROM b LEFT JOIN s USING (ilat)""", "grid8d", "lat_series")
def w6_offset_fix(spark, sf_dir):
    y = view(spark, sf_dir, "lat_series")
    t = view(spark, sf_dir, "grid8d").select("year", "widx").distinct()
    lats = y.select("ilat").distinct().agg(F.collect_set("ilat").alias("l"))
    b = t.join(F.broadcast(lats), F.lit(True)).select("year", "widx", F.explode("l").alias("ilat")).join(y, ["year", "widx", "ilat"], "left")
    b = b.withColumns({"f": 1e5 + F.col("widx") * 100, "t": F.col("year") * 100 + F.col("widx")})
    return co2.offset_fix(b, "y", "f", "ilat", "t").select("year", "widx", "ilat", F.round("f", 3).alias("f"))


STATION_SMOOTH = f"sx AS (SELECT year, widx, v AS x FROM {smooth_sql('(SELECT year, widx, x AS v FROM st)', '', 'year, widx', 3)})"


@query(f"""WITH {STATION}, {STATION_SMOOTH}, b AS (SELECT sx.*, l.ilat, y FROM sx CROSS JOIN (SELECT DISTINCT ilat FROM lat_series) l LEFT JOIN lat_series USING (year, widx, ilat)),
r AS (SELECT ilat, regr_slope(y, x) AS m, avg(y) AS my, avg(x) AS mx FROM b GROUP BY 1), l AS (SELECT b.*, m * x + my - m * mx AS line FROM b JOIN r USING (ilat)),
c AS (SELECT ilat, widx, avg(y - line) AS v FROM l GROUP BY 1, 2), t AS (SELECT c.*, k FROM c CROSS JOIN (SELECT unnest(range(3)) AS k)), s AS (SELECT ilat, widx, v AS cycle FROM {smooth_sql("t", "PARTITION BY ilat", "k, widx", 1)} WHERE k = 1),
f AS (SELECT l.*, line + coalesce(cycle, 0) AS g, year * 100 + widx AS t FROM l LEFT JOIN s USING (ilat, widx)), z AS (SELECT max(t) AS t FROM (SELECT t FROM f GROUP BY t HAVING count(y) = count(*))),
o AS (SELECT ilat, y - g AS shift FROM f WHERE t = (SELECT t FROM z)) SELECT year, widx, ilat, round(x, 3) AS xco2_station, round(coalesce(y, g + coalesce(shift, 0)), 3) AS xco2_filled, round(g + coalesce(shift, 0), 3) AS xco2_regressed, round(y, 3) AS xco2_raw FROM f LEFT JOIN o USING (ilat)""", "series", "lat_series")
def e4_xco2_field(spark, sf_dir):
    out = co2.xco2_field(station(spark, sf_dir), view(spark, sf_dir, "lat_series"))
    return out.withColumns({c: F.round(c, 3) for c in ("xco2_station", "xco2_filled", "xco2_regressed", "xco2_raw")})


# --- scoring ---------------------------------------------------------------------------------------------------------


# --- checks ----------------------------------------------------------------------------------------------------------


@query(f"""WITH t AS (SELECT DISTINCT obs_time FROM obs), c AS (SELECT obs_time, {center("year(obs_time)", "floor((dayofyear(obs_time) - 1) / 8e0)")} AS center FROM t)
SELECT obs_time, center, abs(epoch(obs_time) - epoch(center)) <= 86400 AS ok FROM c""")
def v1_snap_time(spark, sf_dir):
    return quality.snap_time(view(spark, sf_dir, "obs").select("obs_time").distinct(), "obs_time")


@query("""WITH s AS (SELECT DISTINCT year, widx, ilat, ilon, ilat BETWEEN 0 AND 5 AND ilon BETWEEN 0 AND 11 AS inside FROM grid8d),
b AS (SELECT year, widx, 72 - count(*) FILTER (inside) AS m, count(*) FILTER (NOT inside) AS f FROM s GROUP BY 1, 2)
SELECT 'grid' AS "check", concat(year, '-', widx) AS subject, m = 0 AND f = 0 AS ok, concat(m, ',', f) AS detail FROM b""", "grid8d")
def v3_grid_matches(spark, sf_dir):
    return quality.grid_matches(view(spark, sf_dir, "grid8d"), 30.0)


@query("""WITH p AS (SELECT DISTINCT CAST(floor((a + 90) / 30) AS INT) AS ilat, CAST(floor((o + 180) / 30) AS INT) AS ilon FROM (VALUES (20, 25), (-25, 135), (20, -100), (60, 100), (-33, 20)) t(a, o))
SELECT 'land' AS "check", concat(year, '-', widx, '/', ilat, '/', ilon) AS subject, n <= 3 AS ok FROM grid8d JOIN p USING (ilat, ilon)""", "grid8d")
def v4_land_is_empty(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d").withColumn("w", F.when(F.col("n") > 3, F.col("v")))
    return quality.land_is_empty(g, "w", 30.0).drop("detail")


@query("""SELECT 'longitudes' AS "check", concat(year, '-', widx) AS subject, count(DISTINCT o) = 12 AS ok, CAST(12 - count(DISTINCT o) AS VARCHAR) AS detail FROM (SELECT year, widx, CASE WHEN v IS NOT NULL AND NOT (widx % 5 = 0 AND ilon = 11) THEN ilon END AS o FROM grid8d) GROUP BY year, widx""", "grid8d")
def v5_longitudes_present(spark, sf_dir):
    return quality.longitudes_present(view(spark, sf_dir, "grid8d").withColumn("w", F.when((F.col("widx") % 5 != 0) | (F.col("ilon") != 11), F.col("v"))), "w", 12)


@query("""SELECT 'full year' AS "check", CAST(year AS VARCHAR) AS subject, count(DISTINCT widx) = 46 AS ok, CAST(count(DISTINCT widx) AS VARCHAR) AS detail FROM grid8d GROUP BY year
UNION ALL SELECT 'single year', 'all', count(DISTINCT year) = 1, CAST(count(DISTINCT year) AS VARCHAR) FROM grid8d
UNION ALL SELECT 'shape', concat(year, '-', widx), count(DISTINCT ilat) = 6 AND count(DISTINCT ilon) = 12 AND count(DISTINCT ilat * 12 + ilon) = 72, concat(count(DISTINCT ilat), 'x', count(DISTINCT ilon)) FROM grid8d GROUP BY year, widx""", "grid8d")
def v6_v13_year_checks(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d")
    return quality.run_checks([quality.years_full(g), quality.single_year(g), quality.shape_matches(g, 6, 12)], "ignore")


@query(f"""WITH t AS (SELECT DISTINCT year, widx, {center()} + (widx % 3) * INTERVAL 30 MINUTE AS t FROM grid8d) SELECT 'times' AS "check", strftime(t, '%Y-%m-%d %H:%M:%S') AS subject, (widx % 3) * 1800 < 3600 AS ok, CAST((widx % 3) * 1800 AS VARCHAR) AS detail FROM t""", "grid8d")
def v7_times_match(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d").select("year", "widx").distinct()
    return quality.times_match(g.select((cal.center(F.col("year"), F.col("widx")) + F.make_dt_interval(mins=F.col("widx") % 3 * 30)).alias("t")), "t")


@query("""WITH w AS (SELECT y AS year, CAST(w AS INT) AS widx FROM (SELECT DISTINCT year AS y FROM grid8d) CROSS JOIN (SELECT unnest(range(46)) AS w)), n AS (SELECT year, widx, count(CASE WHEN widx % 7 > 0 THEN v END) AS n FROM grid8d GROUP BY 1, 2)
SELECT 'data' AS "check", concat(year, '-', widx) AS subject, coalesce(n, 0) > 0 AS ok, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM w LEFT JOIN n USING (year, widx)""", "grid8d")
def v8_windows_have_data(spark, sf_dir):
    return quality.windows_have_data(view(spark, sf_dir, "grid8d").withColumn("w", F.when(F.col("widx") % 7 > 0, F.col("v"))), "w")


@query(f"""WITH s AS (SELECT DISTINCT 'v' AS variable, year, widx FROM product_b), l AS (SELECT variable, max(year * 46 + widx) AS l FROM s GROUP BY 1),
w AS (SELECT DISTINCT u AS variable, year, widx FROM grid8d CROSS JOIN (SELECT unnest(['v', 'other']) AS u)),
r AS (SELECT w.*, CASE WHEN s.year IS NOT NULL THEN 'exists' WHEN l IS NULL AND w.widx > 0 THEN 'not first' WHEN l IS NOT NULL AND w.year * 46 + w.widx - l <> 1 THEN 'not adjacent' ELSE 'safe' END AS reason
FROM w LEFT JOIN s USING (variable, year, widx) LEFT JOIN l USING (variable)) SELECT variable, year, widx, reason, reason = 'safe' AS ok FROM r""", "grid8d", "product_b")
def v9_v12_append_verdict(spark, sf_dir):
    g = view(spark, sf_dir, "grid8d")
    stored = view(spark, sf_dir, "product_b").select(F.lit("v").alias("variable"), "year", "widx")
    wanted = g.select("year", "widx").distinct().withColumn("variable", F.explode(F.array(F.lit("v"), F.lit("other"))))
    return quality.append_verdict(wanted, stored)


# --- jobs ------------------------------------------------------------------------------------------------------------


@query(f"""WITH c AS (SELECT {W}, CAST(floor(ilat / 3e0) AS INT) AS ilat, CAST(floor(ilon / 3e0) AS INT) AS ilon, round(avg(v), 6) AS v, round(stddev_pop(v), 6) AS v_sigma_regrid FROM cells_daily GROUP BY 1, 2, 3, 4)
SELECT *, {center()} AS window_center FROM c""", "cells_daily")
def b1_product_windows(spark, sf_dir):
    return products.product_windows(view(spark, sf_dir, "cells_daily"), ["v"], 3).withColumns(r6("v", "v_sigma_regrid"))


@query(f"""WITH g AS (SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 5e1) AS INT) AS ilat, CAST(floor(lon10 / 5e1) AS INT) AS ilon, avg(fco2) AS fco2_mean, round(stddev_pop(fco2), 6) AS fco2_std, count(*) AS n FROM obs WHERE obs_time >= TIMESTAMP '1982-01-01' GROUP BY 1, 2, 3, 4)
SELECT *, {center()} AS window_center FROM g""")
def b3_s12_observation_job(spark, sf_dir):
    return products.gridded_observations(view(spark, sf_dir, "obs"), ["fco2"], 5.0).withColumns(r6("fco2_std"))
