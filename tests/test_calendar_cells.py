import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridjobs.functions import calendar as cal
from gridjobs.functions import cells as cf


def test_every_day_from_1980_to_2030_is_in_its_window(spark):
    days = spark.sql("SELECT explode(sequence(DATE '1980-01-01', DATE '2030-12-31')) AS d")
    got = cal.with_window(days, "d").join(cal.windows(spark, 1980, 2030), ["year", "widx"], "left")
    bad = got.filter("window_start IS NULL OR d < window_start OR d >= window_end").count()
    assert bad == 0
    assert got.count() == days.count()


def test_46_windows_and_a_short_last_one(spark):
    w = cal.windows(spark, 1999, 2000).groupBy("year").agg(F.count("*").alias("n"), F.max("window_end").alias("e"), F.max("window_start").alias("s")).orderBy("year").collect()
    assert [r.n for r in w] == [46, 46]
    assert [(r.e - r.s).days for r in w] == [5, 6]
    assert w[0].e == dt.datetime(2000, 1, 1)


def test_windows_not_over_are_left_out(spark):
    assert cal.windows(spark, 2000, 2000, as_of="2000-01-20").count() == 2


def test_adjacent_across_years_and_a_bad_index(spark):
    got = cal.adjacent(spark.createDataFrame([(2000, 0), (2000, 45)], "year int, widx int")).orderBy("widx").collect()
    assert (got[0].prev_year, got[0].prev_widx) == (1999, 45)
    assert (got[1].next_year, got[1].next_widx) == (2001, 0)
    with pytest.raises(Exception, match="no such window"):
        cal.adjacent(spark.createDataFrame([(2000, 46)], "year int, widx int")).collect()


def test_bad_spans_and_days(spark):
    with pytest.raises(ValueError):
        cal.checked(0)
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(cal.index_of_day(F.lit(367))).collect()


def test_steps_per_window(spark):
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-03', INTERVAL 1 HOUR)) AS time")
    assert cal.steps_per_window(hours).first().steps == 192
    assert cal.steps_per_window(hours.limit(1)).first().steps == 1
    with pytest.raises(Exception, match="no time steps"):
        cal.steps_per_window(hours.limit(0)).collect()


def test_cells_and_longitudes(spark):
    got = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (0.0, 359.9), (0.0, 0.0)], "lat double, lon double")
    rows = got.select(cf.lat_index(F.col("lat"), 0.25).alias("a"), cf.lon_index(F.col("lon"), 0.25).alias("o"), cf.wrapped(F.col("lon")).alias("w")).collect()
    assert [(r.a, r.o) for r in rows] == [(0, 0), (719, 0), (360, 719), (360, 720)]
    assert rows[2].w == pytest.approx(-0.1)


def test_missing_becomes_null(spark):
    df = cf.missing_to_null(spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double"), ["v"])
    assert df.agg(F.avg("v")).first()[0] == 1.0


def test_fugacity_is_just_below_the_dry_fraction(spark):
    f = spark.range(1).select(cf.fugacity(F.lit(380.0), F.lit(20.0), F.lit(101325.0), F.lit(35.0)).alias("f"), cf.water_vapour_pressure(F.lit(25.0), F.lit(0.0)).alias("p")).first()
    assert 368 < f.f < 372
    assert f.p * 1013.25 == pytest.approx(31.69, abs=0.05)  # hPa over fresh water at 25 degrees


def test_levels_and_squeeze(spark):
    df = spark.createDataFrame([(1, 5.0, 10.0), (1, 0.5, 20.0), (2, 5.0, None), (2, 0.5, 4.0)], "time int, depth double, v double")
    assert sorted(r.v for r in cf.level(df, ["time"], "depth", ["v"]).collect()) == [4.0, 20.0]
    assert cf.level(df, ["time"], "depth", ["v"], nth=1).filter("time = 1").first().v == 10.0
    assert "one" not in cf.squeezed(df.withColumn("one", F.lit(1)), ["time", "one"]).columns
