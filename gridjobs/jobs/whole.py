"""Registered queries on long series, windows with wings, checks in one pass and jobs from a product to the store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import checks, climatology, co2, fill, halo, intervals, observe, prefix, quality, score
from ..sources import store
from ..sources.shared import fresh
from . import products
from .queries import CELL, W, axis_sql, center, end, query, smooth_sql, start
from .views import view

# --- series of any length --------------------------------------------------------------------------------------------


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@query("""WITH k AS (SELECT epoch_us(ts) AS t, avg(round(value * 1e2)) AS v FROM events WHERE event_id % 3 = 0 GROUP BY 1), q AS (SELECT DISTINCT epoch_us(ts) AS t FROM events),
a AS (SELECT q.t, k.t AS ta, k.v AS va FROM q ASOF LEFT JOIN k ON q.t >= k.t), b AS (SELECT a.*, k.t AS tb, k.v AS vb FROM a ASOF LEFT JOIN k ON a.t <= k.t)
SELECT t, round(CASE WHEN ta = t THEN va ELSE va + (vb - va) * (t - ta) / (tb - ta) END, 3) AS v FROM b""")
def j5_events_as_of(spark, sf_dir):
    """The value at the time of every event, between those of a third of the events."""
    e = events(spark, sf_dir).select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", F.round(F.col("value") * 100).alias("v"))
    knots = e.filter("event_id % 3 = 0").groupBy("t").agg(F.avg("v").alias("v"))
    return co2.at_times(knots, e, "t", "v").withColumn("v", F.round("v", 3))


@query("""WITH n AS (SELECT event_id, CASE WHEN event_id % 7 IN (1, 2, 5) OR event_id < 4 THEN NULL ELSE round(value * 1e2) END AS v, row_number() OVER (ORDER BY event_id) AS i FROM events),
b AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS a, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER p AS ia, first_value(v IGNORE NULLS) OVER f AS z, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER f AS iz
FROM n WINDOW p AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, CASE WHEN iz > ia THEN a + (z - a) * (i - ia) / CAST(iz - ia AS DOUBLE) END, a), 3) AS v FROM b""")
def w5_events_filled(spark, sf_dir):
    """Gaps in one series of all events, filled by position."""
    gap = (F.col("event_id") % 7).isin(1, 2, 5) | (F.col("event_id") < 4)
    e = events(spark, sf_dir).select("event_id", F.when(~gap, F.round(F.col("value") * 100)).alias("v"))
    return fill.interpolate_positions(e, "v", "event_id").withColumn("v", F.round("v", 3))


@query(f"SELECT event_id, round(v, 4) AS v FROM {smooth_sql('(SELECT event_id, value * 1e0 AS v FROM events)', '', 'event_id', 3)}")
def w1_events_smoothed(spark, sf_dir):
    """One series of all events, smoothed three times over."""
    return climatology.smooth(events(spark, sf_dir).select("event_id", F.col("value").cast("double").alias("v")), "v", [], ["event_id"], 3, 3).withColumn("v", F.round("v", 4))


# --- windows with wings ----------------------------------------------------------------------------------------------

FIVE = """five AS (SELECT DATE '1992-01-01' + 5 * CAST(floor(date_diff('day', DATE '1992-01-01', CAST(obs_time AS DATE)) / 5e0) AS INT) AS t, CAST(floor(lat10 / 3e2) AS INT) AS ilat, CAST(floor(lon10 / 3e2) AS INT) AS ilon, avg(fco2) AS v FROM obs GROUP BY 1, 2, 3)"""


@query(f"""WITH {FIVE}, y AS (SELECT unnest(range(1990, 2002)) AS year), k AS (SELECT CAST(year AS INT) AS year, CAST(widx AS INT) AS widx, {start()} AS s, {end()} AS e FROM y CROSS JOIN (SELECT unnest(range(46)) AS widx)),
m AS (SELECT k.year, k.widx, t, e - s AS days FROM k JOIN (SELECT DISTINCT t FROM five) ON t >= s - 5 AND t < e + 4)
SELECT year, widx, CAST(t AS TIMESTAMP) AS t, CAST(days AS INT) AS days FROM m""")
def t9_times_in_wings(spark, sf_dir):
    """Each time of a five-daily field and the windows whose wings hold it."""
    got = intervals.in_wings(five_daily(spark, sf_dir), "t")
    y, w = F.col("year"), F.col("widx")
    return got.select("year", "widx", "t", F.datediff(cal.end(y, w), cal.start(y, w)).alias("days"))


def five_daily(spark, sf_dir):
    day = F.floor(F.datediff(F.to_date("obs_time"), F.lit("1992-01-01").cast("date")) / 5).cast("int") * 5
    at = F.date_add(F.lit("1992-01-01").cast("date"), day).cast("timestamp_ntz").alias("t")
    cell = lambda c: F.floor(F.col(c) / 300).cast("int")
    return view(spark, sf_dir, "obs").groupBy(at, cell("lat10").alias("ilat"), cell("lon10").alias("ilon")).agg(F.avg("fco2").alias("v"))


@query(f"""WITH {FIVE}, y AS (SELECT unnest(range(1990, 2002)) AS year), k AS (SELECT CAST(year AS INT) AS year, CAST(widx AS INT) AS widx, {start()} AS s, {end()} AS e FROM y CROSS JOIN (SELECT unnest(range(46)) AS widx)),
m AS (SELECT k.*, t FROM k JOIN (SELECT DISTINCT t FROM five) ON t >= s - 5 AND t < e + 4), d AS (SELECT year, widx, CAST(unnest(generate_series(s, e - 1, INTERVAL 1 DAY)) AS DATE) AS d FROM k),
b AS (SELECT d.year, d.widx, d, max(CASE WHEN t <= d THEN t END) AS a, min(CASE WHEN t >= d THEN t END) AS z FROM d JOIN m USING (year, widx) GROUP BY 1, 2, 3 HAVING a IS NOT NULL AND z IS NOT NULL),
w AS (SELECT year, widx, d, a AS t, CASE WHEN a = z THEN 1e0 ELSE 1 - (d - a) / CAST(z - a AS DOUBLE) END AS w FROM b UNION ALL SELECT year, widx, d, z, (d - a) / CAST(z - a AS DOUBLE) FROM b WHERE a < z),
v AS (SELECT ilat, ilon, year, widx, d, CASE WHEN sum(w) > 1 - 1e-9 THEN sum(w * v) END AS v FROM five JOIN w USING (t) GROUP BY 1, 2, 3, 4, 5)
SELECT ilat, ilon, year, widx, round(avg(v), 5) AS v, count(v) AS n FROM v GROUP BY 1, 2, 3, 4""")
def t9_g8_wing_means(spark, sf_dir):
    """A five-daily field interpolated to days inside each window's wings, and its means over the windows."""
    return intervals.window_means(five_daily(spark, sf_dir), "v", "t").withColumn("v", F.round("v", 5))


# --- checks ----------------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT DISTINCT year, widx, ilat, ilon FROM grid8d), b AS (SELECT year, widx, concat(year, '-', widx) AS subject, 72 - count(*) AS m, count(DISTINCT ilat) AS a, count(DISTINCT ilon) AS o FROM s GROUP BY 1, 2),
l AS (SELECT year, widx, count(DISTINCT CASE WHEN v IS NOT NULL AND widx % 5 > 0 THEN ilon END) AS o, count(CASE WHEN widx % 5 > 0 THEN v END) AS n FROM grid8d GROUP BY 1, 2),
w AS (SELECT y AS year, CAST(w AS INT) AS widx FROM (SELECT DISTINCT year AS y FROM grid8d) CROSS JOIN (SELECT unnest(range(46)) AS w)),
p AS (SELECT DISTINCT CAST(floor((a + 90) / 30) AS INT) AS ilat, CAST(floor((o + 180) / 30) AS INT) AS ilon FROM (VALUES (20, 25), (-25, 135), (20, -100), (60, 100), (-33, 20)) t(a, o))
SELECT 'grid' AS "check", subject, m = 0 AS ok, concat(m, ',0') AS detail FROM b
UNION ALL SELECT 'shape', subject, m = 0 AND a = 6 AND o = 12, concat(a, 'x', o) FROM b
UNION ALL SELECT 'longitudes', concat(year, '-', widx), o = 12, CAST(12 - o AS VARCHAR) FROM l
UNION ALL SELECT 'data', concat(year, '-', widx), coalesce(n, 0) > 0, CAST(coalesce(n, 0) AS VARCHAR) FROM w LEFT JOIN l USING (year, widx)
UNION ALL SELECT 'land', concat(year, '-', widx, '/', ilat, '/', ilon), NOT (v IS NOT NULL AND widx % 5 > 0), CAST(CAST(v IS NOT NULL AND widx % 5 > 0 AS INT) AS VARCHAR) FROM grid8d JOIN p USING (ilat, ilon)
UNION ALL SELECT 'full year', CAST(year AS VARCHAR), count(DISTINCT widx) = 46, CAST(count(DISTINCT widx) AS VARCHAR) FROM grid8d GROUP BY year
UNION ALL SELECT 'single year', 'all', count(DISTINCT year) = 1, CAST(count(DISTINCT year) AS VARCHAR) FROM grid8d""", "grid8d")
def v13_checks_in_one_pass(spark, sf_dir):
    """Seven checks by name, from one scan of the grid."""
    g = view(spark, sf_dir, "grid8d").withColumn("w", F.when(F.col("widx") % 5 > 0, F.col("v")))
    return checks.run(g, checks.named(list(checks.BY_NAME), "w", 30.0), "ignore")


@query(f"""WITH w AS (SELECT DISTINCT year, widx FROM grid8d), t AS (SELECT {center()} AS t FROM w WHERE NOT (year % 3 = 0 AND widx = 10) UNION ALL SELECT {center()} + INTERVAL 20 MINUTE FROM w WHERE year % 3 = 1 AND widx = 20),
n AS (SELECT CAST(year(t) AS INT) AS year, t, CAST(row_number() OVER (PARTITION BY year(t) ORDER BY t) - 1 AS INT) AS widx FROM t),
c AS (SELECT y AS year, CAST(widx AS INT) AS widx FROM (SELECT DISTINCT year AS y FROM n) CROSS JOIN (SELECT unnest(range(46)) AS widx)), e AS (SELECT year, widx, {center()} AS center FROM c),
b AS (SELECT coalesce(n.year, e.year) AS year, coalesce(n.widx, e.widx) AS widx, t, center, CAST(abs(epoch(t) - epoch(center)) AS BIGINT) AS off FROM n FULL JOIN e ON n.year = e.year AND n.widx = e.widx)
SELECT 'times' AS "check", concat(year, '-', widx) AS subject, coalesce(off < 3600, false) AS ok, CASE WHEN t IS NULL THEN 'missing' WHEN center IS NULL THEN 'surplus' ELSE CAST(off AS VARCHAR) END AS detail FROM b""", "grid8d")
def v7_times_in_order(spark, sf_dir):
    """Steps that lack a window in some years and have one twice in others, against the calendar by their order."""
    w = view(spark, sf_dir, "grid8d").select("year", "widx").distinct().withColumn("t", cal.center(F.col("year"), F.col("widx")))
    twice = w.filter("year % 3 = 1 AND widx = 20").withColumn("t", F.col("t") + F.make_dt_interval(mins=F.lit(20)))
    return quality.times_in_order(w.filter("NOT (year % 3 = 0 AND widx = 10)").union(twice), "t")


# --- from products to the store --------------------------------------------------------------------------------------


def gap_sql(source: str, names: list[str], nlon: int, as_float: str = "CAST(CAST({0} AS FLOAT) AS DOUBLE)") -> str:
    """Longitudes without any value filled from their neighbours across the date line, of each of the names."""
    o = f"(ilon + {nlon // 2}) % {nlon}"
    cols = [
        f"""CASE WHEN count({v}) OVER (PARTITION BY year, widx, ilon) > 0 THEN {v} WHEN {v} IS NOT NULL THEN {v} WHEN first_value(CASE WHEN {v} IS NOT NULL THEN o END IGNORE NULLS) OVER f > last_value(CASE WHEN {v} IS NOT NULL THEN o END IGNORE NULLS) OVER p
 THEN last_value({v} IGNORE NULLS) OVER p + (first_value({v} IGNORE NULLS) OVER f - last_value({v} IGNORE NULLS) OVER p) * (o - last_value(CASE WHEN {v} IS NOT NULL THEN o END IGNORE NULLS) OVER p)
 / CAST(first_value(CASE WHEN {v} IS NOT NULL THEN o END IGNORE NULLS) OVER f - last_value(CASE WHEN {v} IS NOT NULL THEN o END IGNORE NULLS) OVER p AS DOUBLE) END AS {v}"""
        for v in names
    ]
    return f"""SELECT year, widx, ilat, ilon, {", ".join(cols)} FROM (SELECT *, {o} AS o FROM ({source}))
WINDOW p AS (PARTITION BY year, widx, ilat ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY year, widx, ilat ORDER BY o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def spine_sql(windows: str, nlat: int, nlon: int) -> str:
    return f"SELECT year, widx, CAST(a AS INT) AS ilat, CAST(o AS INT) AS ilon FROM (SELECT DISTINCT year, widx FROM {windows}) CROSS JOIN (SELECT unnest(range({nlat})) AS a) CROSS JOIN (SELECT unnest(range({nlon})) AS o)"


F8 = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"
PARTS = ["v", "v_sigma_regrid"]
INTERPOLATED = ", ".join(f"{F8.format(f'CASE WHEN sum(CASE WHEN {v} IS NOT NULL THEN wlat * wlon END) > 1 - 1e-9 THEN sum(wlat * wlon * {v}) END')} AS {v}" for v in PARTS)


@query(f"""WITH c AS (SELECT {W}, CAST(floor(ilat / 3e0) AS INT) AS ilat, CAST(floor(ilon / 3e0) AS INT) AS ilon, avg(v) AS v, stddev_pop(v) AS v_sigma_regrid FROM cells_daily GROUP BY 1, 2, 3, 4),
a AS ({axis_sql(6, 9, 180.0, "ilat")}), o AS ({axis_sql(12, 18, 360.0, "ilon")}),
g AS (SELECT year, widx, jlat AS ilat, jlon AS ilon, {INTERPOLATED} FROM c JOIN a USING (ilat) JOIN o USING (ilon) GROUP BY 1, 2, 3, 4),
s AS ({spine_sql("c", 9, 18)}), b AS (SELECT s.*, v, v_sigma_regrid FROM s LEFT JOIN g USING (year, widx, ilat, ilon)), z AS ({gap_sql("SELECT * FROM b", PARTS, 18)})
SELECT year, widx, ilat, ilon, round({F8.format("v")}, 2) AS v, round({F8.format("v_sigma_regrid")}, 2) AS v_sigma_regrid FROM z""", "cells_daily")
def b1_store_product(spark, sf_dir):
    """A product at 10 degrees to the store at 20: regridded, completed, checked, appended in one commit, and opened again."""
    root, p = fresh(spark, "product"), products.Product(view(spark, sf_dir, "cells_daily"), ["v"], 10.0, 3, 20.0)
    products.store_product(p, root)
    got = store.open_store(spark, root, p.names)
    return got.select(*CELL, *[F.round(F.col(v).cast("double"), 2).alias(v) for v in p.names])


MERGED = ["v_a", "v_sigma_regrid_a", "w_b", "w_sigma_regrid_b"]


@query(f"""WITH c AS (SELECT {W}, CAST(floor(ilat / 3e0) AS INT) AS ilat, CAST(floor(ilon / 3e0) AS INT) AS ilon, {F8.format("avg(v)")} AS v_a, {F8.format("stddev_pop(v)")} AS v_sigma_regrid_a FROM cells_daily GROUP BY 1, 2, 3, 4),
d AS (SELECT o_orderdate AS time, CAST(o_custkey % 6 AS INT) AS ilat, CAST(o_orderkey % 12 AS INT) AS ilon, avg(round(o_totalprice)) AS w FROM orders GROUP BY 1, 2, 3),
e AS (SELECT {W}, ilat, ilon, {F8.format("avg(w)")} AS w_b, {F8.format("stddev_pop(w)")} AS w_sigma_regrid_b FROM d GROUP BY 1, 2, 3, 4),
sa AS ({spine_sql("c", 6, 12)}), sb AS ({spine_sql("e", 6, 12)}), za AS ({gap_sql("SELECT sa.*, v_a, v_sigma_regrid_a FROM sa LEFT JOIN c USING (year, widx, ilat, ilon)", MERGED[:2], 12)}),
zb AS ({gap_sql("SELECT sb.*, w_b, w_sigma_regrid_b FROM sb LEFT JOIN e USING (year, widx, ilat, ilon)", MERGED[2:], 12)})
SELECT year, widx, ilat, ilon, {", ".join(f"round({F8.format(v)}, 1) AS {v}" for v in MERGED)} FROM za FULL JOIN zb USING (year, widx, ilat, ilon)""", "cells_daily")
def b2_store_catalog(spark, sf_dir):
    """Two products of unlike windows, merged cell by cell and appended together; a window that one lacks has nulls for it."""
    root = fresh(spark, "catalog")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cells = orders.groupBy(F.col("o_orderdate").alias("time"), (F.col("o_custkey") % 6).cast("int").alias("ilat"), (F.col("o_orderkey") % 12).cast("int").alias("ilon")).agg(F.avg(F.round("o_totalprice")).alias("w"))
    both = {"a": products.Product(view(spark, sf_dir, "cells_daily"), ["v"], 10.0, 3, 30.0), "b": products.Product(cells, ["w"], 30.0, 1, 30.0)}
    products.store_catalog(both, root)
    return store.open_store(spark, root, MERGED).select(*CELL, *[F.round(F.col(v).cast("double"), 1).alias(v) for v in MERGED])


@query("""WITH g AS (SELECT ilat, ilon, widx AS season_key, CAST(CAST(v AS FLOAT) AS DOUBLE) AS v FROM grid8d), c AS (SELECT ilat, ilon, season_key, avg(v) AS c FROM g GROUP BY 1, 2, 3), l AS (SELECT ilat, ilon, avg(v) AS l FROM g GROUP BY 1, 2)
SELECT ilat, ilon, season_key, round(c, 4) AS clim_v, round(c - l, 4) AS seas_v FROM c JOIN l USING (ilat, ilon)""", "grid8d")
def a1_a2_kept_climatology(spark, sf_dir):
    """Three appends that carry the sums on, and the climatology from the sums alone."""
    g, root = view(spark, sf_dir, "grid8d"), fresh(spark, "kept")
    for year in (1994, 1997, 9999):
        store.append(g.filter(F.col("year") < year), root, ["v"], states=True)
    return products.kept_climatology(spark, root, "v").select("ilat", "ilon", "season_key", F.round("clim_v", 4).alias("clim_v"), F.round("seas_v", 4).alias("seas_v"))


FLOATS = f"g AS (SELECT year, widx, ilat, ilon, {F8.format('v')} AS v FROM grid8d)"


@query(f"""WITH {FLOATS}, f AS (SELECT year, widx, ilat, ilon, v - avg(v) OVER s AS anom_v, CASE WHEN (year * 46 + widx) - lag(year * 46 + widx) OVER w = 1 THEN v - lag(v) OVER w END AS delta_v,
avg(v) OVER s AS clim_v, avg(v) OVER s - avg(v) OVER p AS seas_v FROM g WINDOW p AS (PARTITION BY ilat, ilon), s AS (PARTITION BY ilat, ilon, widx), w AS (PARTITION BY ilat, ilon ORDER BY year, widx)),
o AS (SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 3e2) AS INT) AS ilat, CAST(floor(lon10 / 3e2) AS INT) AS ilon,
avg(sst) AS sst_mean, count(*) AS n FROM obs WHERE fco2 >= 49 GROUP BY 1, 2, 3, 4)
SELECT year, widx, ilat, ilon, sst_mean, n, round(anom_v, 4) AS anom_v, round(delta_v, 4) AS delta_v, round(clim_v, 4) AS clim_v, round(seas_v, 4) AS seas_v FROM o JOIN f USING (year, widx, ilat, ilon)""", "grid8d")
def j9_s11_stored_training(spark, sf_dir):
    """The features of cells and windows with the highest observed values, from the store: few files, few rows, no pass over the record."""
    root = fresh(spark, "training")
    store.append(view(spark, sf_dir, "grid8d"), root, ["v"], states=True)
    seen = observe.grid(view(spark, sf_dir, "obs").filter("fco2 >= 49"), ["sst"], 30.0).drop("sst_std")
    got = products.stored_training_table(spark, seen, root, ["v"])
    return got.withColumns({f"{p}_v": F.round(f"{p}_v", 4) for p in ("anom", "delta", "clim", "seas")})


# --- gaps and their neighbours ---------------------------------------------------------------------------------------


def beside_sql(source: str, at: str, *line: str) -> str:
    """Each null from one position before on an axis, else from the one after."""
    same = " AND ".join(f"s.{c} = {{0}}.{c}" for c in line)
    return f"""SELECT s.year, s.widx, s.ilat, s.ilon, s.t, coalesce(s.v, b.v, e.v) AS v FROM {source} s
LEFT JOIN {source} b ON {same.format("b")} AND b.{at} = s.{at} - 1 LEFT JOIN {source} e ON {same.format("e")} AND e.{at} = s.{at} + 1"""


@query(f"""WITH s AS (SELECT year, widx, ilat, ilon, year * 46 + widx AS t, CASE WHEN n > 1 THEN v END AS v FROM grid8d),
a AS ({beside_sql("s", "t", "ilat", "ilon")}), b AS ({beside_sql("a", "ilat", "t", "ilon")}), c AS ({beside_sql("b", "ilon", "t", "ilat")}) SELECT year, widx, ilat, ilon, v FROM c""", "grid8d")
def w4_f3_fill_beside(spark, sf_dir):
    """Gaps from the cells beside them in time, latitude and longitude; cells that aren't beside a gap don't travel."""
    g = view(spark, sf_dir, "grid8d").select(*CELL, (F.col("year") * 46 + F.col("widx")).alias("t"), F.when(F.col("n") > 1, F.col("v")).alias("v"))
    return halo.fill_gaps(g, "v", [(["ilat", "ilon"], "t"), (["t", "ilon"], "ilat"), (["t", "ilat"], "ilon")]).select(*CELL, "v")


# --- scoring by stored networks --------------------------------------------------------------------------------------

RELU = "greatest(0e0, (list_dot_product({x}, u.weights) + bias - mean) / sqrt(variance + 1e-5) * gain + shift)"
LAYER = "SELECT vec_id, x.member, list({relu} ORDER BY unit) AS h FROM {x} x JOIN u ON u.layer = {layer} AND u.member = x.member GROUP BY 1, 2"


def units_sql(layer: int, first: int, last: int, wide: int) -> str:
    return f"""SELECT member, {layer} AS layer, i - member * 97 - {first} AS unit, e[1:{wide}] AS weights, e[2] AS bias, e[3] AS mean, e[4] * e[4] + 5e-1 AS variance, 1 + e[5] AS gain, e[6] AS shift
FROM n JOIN (SELECT unnest(range(5)) AS member) m ON i BETWEEN member * 97 + {first} AND member * 97 + {last - 1}"""


@query(f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), n AS (SELECT e, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM v),
u AS ({units_sql(0, 0, 64, 64)} UNION ALL {units_sql(1, 64, 96, 64)} UNION ALL {units_sql(2, 96, 97, 32)}), m AS (SELECT DISTINCT member FROM u), z AS (SELECT vec_id, member, e AS h FROM v CROSS JOIN m),
a AS ({LAYER.format(relu=RELU.format(x="x.h"), x="z", layer=0)}), b AS ({LAYER.format(relu=RELU.format(x="x.h"), x="a", layer=1)}),
p AS (SELECT vec_id, b.member, list_dot_product(b.h, u.weights) + bias AS y FROM b JOIN u ON u.layer = 2 AND u.member = b.member)
SELECT vec_id, round(avg(y), 6) AS mean, round(stddev_pop(y), 6) AS std, count(y) AS members FROM p GROUP BY 1""")
def m1_m2_ensemble(spark, sf_dir):
    """Five networks, whose units' numbers are vectors of the table, written, loaded and run on all vectors: mean and spread for each."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    n = prefix.numbered(e, ["vec_id"], "i").filter("i < 485").withColumns({"member": F.expr("CAST(i DIV 97 AS INT)"), "j": F.col("i") % 97})
    layer = F.when(F.col("j") < 64, 0).when(F.col("j") < 96, 1).otherwise(2)
    unit = (F.col("j") - F.when(F.col("j") < 64, 0).when(F.col("j") < 96, 64).otherwise(96)).cast("int")
    c = lambda k: F.col("e")[k]
    units = n.select("member", layer.alias("layer"), unit.alias("unit"), F.slice("e", 1, F.when(F.col("j") < 96, 64).otherwise(32)).alias("weights"), c(1).alias("bias"), c(2).alias("mean"), (c(3) * c(3) + 0.5).alias("variance"), (1 + c(4)).alias("gain"), c(5).alias("shift"))
    path = fresh(spark, "networks")
    units.write.parquet(path)
    out = score.ensemble(score.predict(e, ["vec_id"], "e", score.load_members(spark, path)), ["vec_id"])
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})
