"""Deterministic views of the given tables that stand for gridded products; the SQL runs unchanged in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = """SELECT l_shipdate AS obs_time, CAST((l_partkey * 7) % 1800 AS INT) AS lat10,
  CAST((l_orderkey * 11) % 3600 AS INT) AS lon10_raw, CAST((l_orderkey * 11 + 1800) % 3600 AS INT) AS lon10,
  (CAST((l_partkey * 7) % 1800 AS DOUBLE) + 5e-1) / 1e1 - 9e1 AS lat, (CAST((l_orderkey * 11) % 3600 AS DOUBLE) + 5e-1) / 1e1 AS lon,
  l_quantity AS fco2, round(l_extendedprice * 1e2) AS sst, round(l_discount * 1e2) AS sst_sigma_uncert,
  concat('S', CAST(l_suppkey AS VARCHAR(20))) AS expocode, l_returnflag AS qc_flag FROM lineitem"""
CELLS_DAILY = """SELECT obs_time AS time, CAST(floor(lat10 / 1e2) AS INT) AS ilat, CAST(floor(lon10 / 1e2) AS INT) AS ilon,
  avg(fco2) AS v, avg(sst_sigma_uncert) AS v_sigma_uncert, min(CASE WHEN qc_flag = 'R' THEN 2 ELSE 1 END) AS flag_p
  FROM obs GROUP BY 1, 2, 3"""
WINDOW = "CAST(year({0}) AS INT) AS year, CAST(floor((dayofyear({0}) - 1) / 8e0) AS INT) AS widx"
GRID8D = f"""SELECT {WINDOW.format("obs_time")}, CAST(floor(lat10 / 3e2) AS INT) AS ilat, CAST(floor(lon10 / 3e2) AS INT) AS ilon,
  avg(fco2) AS v, round(stddev_pop(fco2), 6) AS v_sd, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4"""
PRODUCT_B = f"""SELECT {WINDOW.format("o_orderdate")}, CAST(o_custkey % 6 AS INT) AS ilat, CAST(o_orderkey % 12 AS INT) AS ilon,
  avg(round(o_totalprice * 1e2)) AS v_b FROM orders GROUP BY 1, 2, 3, 4"""
SERIES = """SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS d,
  CASE WHEN count(*) % 7 = 0 THEN NULL ELSE avg(round(o_totalprice * 1e2)) END AS x FROM orders GROUP BY 1"""
LAT_SERIES = f"""SELECT {WINDOW.format("obs_time")}, CAST(floor(lat10 / 3e2) AS INT) AS ilat,
  avg(CASE WHEN year(obs_time) <= 2000 THEN sst END) AS y FROM obs GROUP BY 1, 2, 3"""
WIND_HOURLY = """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, CAST(user_id % 6 AS INT) AS ilat, CAST((event_id * 5) % 12 AS INT) AS ilon,
  avg(round(value * 1e2) - 25e3) AS u10, avg(CAST((event_id * 37) % 500 AS DOUBLE) * 1e2 - 25e3) AS v10 FROM events GROUP BY 1, 2, 3"""
PAIRS = """SELECT l_linenumber AS grp, round(l_extendedprice * 1e2) AS y_true,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_quantity * 2e5 END AS y_pred FROM lineitem"""
VIEWS = {"obs": OBS, "cells_daily": CELLS_DAILY, "grid8d": GRID8D, "product_b": PRODUCT_B, "series": SERIES, "lat_series": LAT_SERIES, "wind_hourly": WIND_HOURLY, "pairs": PAIRS}
TABLES = ("lineitem", "orders", "events")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; the tables are named only while the text is read."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    spark.sql(OBS).createOrReplaceTempView("obs")
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """The query for DuckDB, with the views that it reads before it."""
    own = ["obs", *[n for n in names if n != "obs"]]
    parts = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in own)
    body = sql.strip()
    return f"WITH {parts}{', ' + body[5:] if body.upper().startswith('WITH ') else chr(10) + body}"
