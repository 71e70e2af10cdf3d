"""What follows a row is found by a frame that grows in the reverse order: one that ends with the last row is gone through anew for each row."""

from pyspark.sql import functions as F

from gridjobs.operators import co2, fill, prefix


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().lower()


def one_range(spark, n):
    """Every third value of a series is known; all of it is one range."""
    return spark.range(n, numPartitions=1).select(F.col("id").cast("double").alias("t"), F.when(F.col("id") % 3 == 0, F.col("id") * 2.0).alias("v"))


def test_as_of_has_no_frame_to_the_last_row(spark):
    df = one_range(spark, 300_000)
    got = co2.at_times(df, df, "t", "v")
    assert "unboundedpreceding" in plan(got)
    assert "unboundedfollowing" not in plan(got)
    assert got.filter(F.abs(F.col("v") - 2 * F.col("t")) < 1e-6).count() == 299_998  # nothing is known after the last two
    assert got.filter("v IS NULL").count() == 2


def test_rows_with_equal_keys_have_one_order_both_ways(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (1, 5.0), (1, None), (2, 9.0)], "t int, v double").coalesce(1)
    of = prefix.known_around(df, "v", ["t"]).filter("t = 1 AND v IS NULL").collect()
    assert len(of) == 2
    assert all((r.before.v, r.after.v) in ((1.0, 5.0), (5.0, 9.0)) for r in of)


def test_filling_by_position_has_no_frame_to_the_last_row(spark):
    df = one_range(spark, 300_000)
    got = fill.interpolate_positions(df, "v", "t")
    assert "unboundedfollowing" not in plan(got)
    assert got.filter(F.abs(F.col("v") - F.least(2 * F.col("t"), F.lit(599_994.0))) < 1e-6).count() == 300_000
    # series by parts, one of which has nearly all rows
    parts = df.withColumn("k", (F.col("t") < 5).cast("int"))
    got = fill.interpolate_positions(parts, "v", "t", ["k"])
    assert "unboundedfollowing" not in plan(got)
    assert got.filter("k = 0 AND t > 5 AND t < 299998").filter(F.abs(F.col("v") - 2 * F.col("t")) < 1e-6).count() == 299_992
    assert {r.t: r.v for r in got.filter("k = 1").collect()} == {0.0: 0.0, 1.0: 2.0, 2.0: 4.0, 3.0: 6.0, 4.0: 6.0}
