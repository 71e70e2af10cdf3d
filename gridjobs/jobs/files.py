"""Registered queries on files and on the store: the given tables are written to the shared folder in a source's format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import co2, quality
from ..sources import readers, store
from ..sources.shared import fresh
from . import products, whole
from .queries import CELL, ORACLES, QUERIES, center, query
from .views import view

__all__ = ["ORACLES", "QUERIES", "whole"]


def text_file(head: list[str], rows: DataFrame, path: str) -> None:
    """One text file: the head's lines, then the rows (at, line) in order. Only for series of a row for each week or month."""
    spark = rows.sparkSession
    top = spark.createDataFrame(list(enumerate(head, -len(head))), "at long, line string")
    top.union(rows.select("at", "line")).repartition(1).sortWithinPartitions("at").select("line").write.text(path)


@query("""SELECT CAST(strftime(o_orderdate, '%Y%m') AS INT) AS month, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")
def s3_read_dated(spark, sf_dir):
    """Orders in a path for each month; asked for are the months of 1990 to 2010, of which only some exist."""
    root = fresh(spark, "dated")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("month", F.date_format("o_orderdate", "yyyyMM").cast("int"))
    orders.select("o_orderkey", "month", F.col("month").alias("m")).write.partitionBy("m").parquet(root)
    got = readers.read_dated(spark, [f"{root}/m={y}{m:02d}" for y in range(1990, 2011) for m in range(1, 13)])
    return got.groupBy("month").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query(None)
def s5_station_series(spark, sf_dir):
    """The weekly series as a station's CSV with comments, blanks in a name and -999.99 for null."""
    s = view(spark, sf_dir, "series")
    line = F.concat_ws(", ", F.year("d"), F.month("d"), F.dayofmonth("d"), F.coalesce(F.col("x").cast("string"), F.lit("-999.99")))
    path = fresh(spark, "station")
    text_file(["# weekly", "# mean", "year,month,day,increase since 1800"], s.select(F.unix_date("d").alias("at"), line.alias("line")), path)
    return readers.station_series(spark, path).select(F.col("d").cast("timestamp_ntz").alias("d"), F.round("x", 4).alias("x"))


ORACLES["s5_station_series"] = ORACLES["w5_interpolate_positions"]


@query("""WITH m AS (SELECT year(o_orderdate) + (month(o_orderdate) - 5e-1) / 12e0 AS x, o_custkey % 41 AS k, avg(round(o_totalprice * 1e2)) AS v FROM orders GROUP BY 1, 2),
g AS (SELECT x, CAST(k AS INT) AS k FROM (SELECT DISTINCT x FROM m) CROSS JOIN (SELECT unnest(range(41)) AS k))
SELECT CAST(make_date(CAST(floor(x) AS INT), 1, 1) + CAST(floor((x - floor(x)) * 365) AS INT) AS TIMESTAMP) AS day, k, round(degrees(asin(-1 + 2 * k / 4e1)), 6) AS lat, round(coalesce(v, 0), 3) AS v
FROM g LEFT JOIN m USING (x, k)""")
def s6_surface_table(spark, sf_dir):
    """Monthly means of 41 groups as a surface table: a decimal year, then a value and an uncertainty for each sine latitude."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    x = F.year("o_orderdate") + (F.month("o_orderdate") - 0.5) / 12.0
    m = o.groupBy(x.alias("x"), (F.col("o_custkey") % 41).cast("int").alias("k")).agg(F.avg(F.round(F.col("o_totalprice") * 100)).alias("v"))
    rows = m.groupBy("x").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("of"))
    values = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda k: F.concat(F.coalesce(F.col("of")[k], F.lit(0.0)).cast("string"), F.lit(" 0.5")))
    path = fresh(spark, "surface")
    lines = rows.select(F.floor(F.col("x") * 1000).alias("at"), F.concat_ws(" ", F.col("x").cast("string"), F.concat_ws(" ", values)).alias("line"))
    text_file(["# MBL mean SURFACE", "# decimal year, values"], lines, path)
    got = readers.surface_table(spark, path)
    return got.select(F.col("d").cast("timestamp_ntz").alias("day"), "k", F.round("lat", 6).alias("lat"), F.round("value", 3).alias("v"))


@query("SELECT expocode, obs_time, lat, lon, fco2, sst, qc_flag, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4, 5, 6, 7")
def s7_observations_to_parquet(spark, sf_dir):
    columns = ["expocode", "obs_time", "lat", "lon", "fco2", "sst", "qc_flag"]
    obs = view(spark, sf_dir, "obs").select(*columns)
    tsv = fresh(spark, "observations-tsv")
    obs.write.csv(tsv, sep="\t", header=True)
    schema = ", ".join(f"{c} {t}" for c, t in obs.dtypes)
    return readers.observations_to_parquet(spark, tsv, fresh(spark, "observations"), schema).groupBy(*columns).agg(F.count("*").alias("n"))


@query(f"""WITH g AS (SELECT CAST(year(obs_time) AS INT) AS year, CAST(floor((dayofyear(obs_time) - 1) / 8e0) AS INT) AS widx, CAST(floor(lat10 / 5e1) AS INT) AS ilat, CAST(floor(lon10 / 5e1) AS INT) AS ilon,
round(avg(fco2), 6) AS fco2_mean, round(stddev_pop(fco2), 6) AS fco2_std, round(avg(sst), 3) AS sst_mean, round(stddev_pop(sst), 3) AS sst_std, count(*) AS n, count(DISTINCT expocode) AS expocode_n, count(DISTINCT qc_flag) AS qc_flag_n FROM obs WHERE year(obs_time) >= 1982 GROUP BY 1, 2, 3, 4)
SELECT {center()} AS time, (ilat + 5e-1) * 5 - 90 AS lat, (ilon + 5e-1) * 5 - 180 AS lon, fco2_mean, fco2_std, sst_mean, sst_std, n, expocode_n, qc_flag_n FROM g""")
def b3_s12_observation_store(spark, sf_dir):
    """Observations as TSV, then the whole job: Parquet, codes, cells, written by year, read again under other names."""
    obs = view(spark, sf_dir, "obs").select("expocode", "obs_time", "lat", "lon", F.col("fco2").alias("fco2_rec"), F.col("sst").alias("sst_deg"), "qc_flag")
    tsv = fresh(spark, "observations-tsv")
    obs.write.csv(tsv, sep="\t", header=True)
    schema = ", ".join(f"{c} {t}" for c, t in obs.dtypes)
    got = products.observation_job(spark, tsv, fresh(spark, "observations"), schema, {"fco2_rec": "fco2", "sst_deg": "sst"}, ["expocode", "qc_flag"], 5.0)
    return got.withColumns({c: F.round(c, 6 if c.startswith("fco2") else 3) for c in ("fco2_mean", "fco2_std", "sst_mean", "sst_std")})


@query("SELECT CASE grp % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS subset, CAST(y_true AS FLOAT) AS y_true, CAST(y_pred AS FLOAT) AS y_pred, count(*) AS n FROM pairs GROUP BY 1, 2, 3", "pairs")
def s8_split_table(spark, sf_dir):
    pairs, root, columns = view(spark, sf_dir, "pairs"), fresh(spark, "splits"), ["y_true", "y_pred"]
    subsets = ("train", "val", "test")
    for i, name in enumerate(subsets):
        pairs.filter(F.col("grp") % 3 == i).select(*columns).write.csv(f"{root}/all/{name}.csv", header=True)
    got = readers.concat(readers.split_table(spark, root, "all", name, columns).withColumn("subset", F.lit(name)) for name in subsets)
    return got.groupBy("subset", *columns).agg(F.count("*").alias("n"))


@query("""SELECT 'v' AS variable, year, widx, ilat, ilon, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 3) AS x FROM grid8d
UNION ALL SELECT 'n', year, widx, ilat, ilon, CAST(n AS DOUBLE) FROM grid8d""", "grid8d")
def s9_store_append(spark, sf_dir):
    """All windows appended in two steps, the second of which repeats what the first has stored."""
    g, root = view(spark, sf_dir, "grid8d"), fresh(spark, "store")
    store.append(g.filter("year < 1998"), root, ["v", "n"])
    store.append(g, root, ["v", "n"])
    rows = lambda v: store.open_years(spark, root, v).select(F.lit(v).alias("variable"), *CELL, F.round(F.col(v).cast("double"), 3).alias("x"))
    return rows("v").union(rows("n"))


@query(f"""WITH y AS (SELECT year FROM grid8d GROUP BY 1 HAVING count(DISTINCT widx) = 46)
SELECT ilat, ilon, CAST(dayofyear({center()}) AS INT) AS season_key, round(avg(CAST(CAST(v AS FLOAT) AS DOUBLE)), 4) AS clim_v FROM grid8d JOIN y USING (year) GROUP BY 1, 2, 3""", "grid8d")
def s10_s11_a1_stored_climatology(spark, sf_dir):
    """The years that the check passes are stored one by one, opened together and averaged by season."""
    g, root = view(spark, sf_dir, "grid8d"), fresh(spark, "years")
    for r in quality.years_full(g).filter("ok").collect():  # a row for each year
        products.store_year(g.filter(F.col("year") == int(r.subject)), root, ["v"])
    return products.stored_climatology(spark, root, "v").withColumn("clim_v", F.round("clim_v", 4))


FUGACITY = ORACLES["p13_e5_j7_fugacity"]


@query("""WITH c AS (SELECT g.year, g.widx, g.ilat, g.ilon, 3.5e2 + y / 1e6 AS x, g.ilat * 5e0 AS t, 1e5 + n AS p, 3e1 + g.ilon / 4e0 AS s FROM grid8d g LEFT JOIN lat_series l ON l.year = g.year AND l.widx = g.widx AND l.ilat = g.ilat),
""" + FUGACITY[FUGACITY.index("k AS (SELECT *, t + 273.15") :], "grid8d", "lat_series")
def e5_j7_fco2(spark, sf_dir):
    """Fugacity of CO2 in air on the grid, from the latitude-time field and the cells' temperature, pressure and salinity."""
    cells = view(spark, sf_dir, "grid8d").select(*CELL, (F.col("ilat") * 5.0).alias("sst"), (1e5 + F.col("n")).alias("msl"), (30 + F.col("ilon") / 4).alias("sss"))
    field = view(spark, sf_dir, "lat_series").select("year", "widx", "ilat", (350 + F.col("y") / 1e6).alias("xco2_filled"))
    return co2.fco2(cells, field).select(*CELL, F.round("fco2", 5).alias("fco2"))
