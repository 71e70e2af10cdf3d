import pytest
from pyspark.sql import functions as F

from gridjobs.jobs import products
from gridjobs.operators import climatology, co2, observe, quality, score
from gridjobs.sources import readers, store

GRID = [(2023, 0, a, o, float(1 + 2 * a + o)) for a in range(2) for o in range(2)]
CELLS = "year int, widx int, ilat int, ilon int, temperature double"


def test_membership_of_times(spark):
    stored = spark.createDataFrame(GRID, CELLS)
    one = lambda w: spark.createDataFrame([(2023, w)], "year int, widx int")
    assert quality.not_stored(one(0), stored).count() == 0
    assert quality.not_stored(one(1), stored).count() == 1
    assert quality.not_stored(one(0), stored.limit(0)).count() == 1
    other = stored.withColumnRenamed("widx", "custom")
    assert quality.not_stored(one(0).withColumnRenamed("widx", "custom"), other, ["year", "custom"]).count() == 0


def test_append_verdicts(spark):
    stored = spark.createDataFrame([("t", 2022, 45)], "variable string, year int, widx int")
    wanted = spark.createDataFrame([("t", 2022, 45), ("t", 2023, 0), ("t", 2023, 1), ("u", 2023, 0), ("u", 2023, 1)], "variable string, year int, widx int")
    got = {(r.variable, r.year, r.widx): r.reason for r in quality.append_verdict(wanted, stored).collect()}
    assert got == {("t", 2022, 45): "exists", ("t", 2023, 0): "safe", ("t", 2023, 1): "not adjacent", ("u", 2023, 0): "safe", ("u", 2023, 1): "not first"}
    safe = {(r.year, r.widx): r.ok for r in quality.all_safe(quality.append_verdict(wanted, stored)).collect()}
    assert safe == {(2022, 45): False, (2023, 0): True, (2023, 1): False}


def test_store_appends_in_order_and_refuses_gaps(spark, tmp_path):
    root, cells = str(tmp_path), spark.createDataFrame(GRID, CELLS)
    assert store.append(cells, root, ["temperature"]) == [(2023, 0)]
    assert store.append(cells, root, ["temperature"]) == []
    with pytest.raises(ValueError, match="follow"):
        store.append(cells.withColumn("widx", F.lit(2)), root, ["temperature"])
    store.append(cells.withColumn("widx", F.lit(1)), root, ["temperature"])
    assert store.open_years(spark, root, "temperature").count() == 8
    with pytest.raises(ValueError, match="full year"):
        store.open_years(spark, root, "temperature", quality.years_full)
    with pytest.raises(ValueError, match="first window"):
        store.append(cells.withColumn("widx", F.lit(3)), f"{root}/other", ["temperature"])


def test_store_writes_a_year_or_replaces_it(spark, tmp_path):
    root, cells = str(tmp_path), spark.createDataFrame(GRID, CELLS)
    store.write_year(cells, root, ["temperature"])
    with pytest.raises(ValueError, match="stored"):
        store.write_year(cells, root, ["temperature"])
    store.write_year(cells.withColumn("temperature", F.lit(9.0)), root, ["temperature"], overwrite=True)
    store.write_year(cells.withColumn("year", F.lit(2024)), root, ["temperature"])
    got = store.open_years(spark, root, "temperature").groupBy("year").agg(F.max("temperature").alias("m")).orderBy("year").collect()
    assert [(r.year, r.m) for r in got] == [(2023, 9.0), (2024, 4.0)]
    with pytest.raises(ValueError, match="one year"):
        store.write_year(cells.union(cells.withColumn("year", F.lit(2025))), root, ["temperature"])


def test_a_failed_append_leaves_the_store_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    cells = spark.createDataFrame(GRID, CELLS).withColumn("other", F.col("temperature"))
    both = ["temperature", "other"]
    assert store.append(cells, root, both) == [(2023, 0)]
    late = cells.withColumn("widx", F.lit(1))
    broken = late.withColumn("other", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        store.append(broken, root, both)
    assert {(r.variable, r.widx) for r in store.stored_windows(spark, root, both).collect()} == {("temperature", 0), ("other", 0)}
    store.append(late.drop("other"), root, ["temperature"])  # one variable is ahead
    assert store.append(late, root, both) == [(2023, 1)]
    assert [store.open_years(spark, root, v).count() for v in both] == [8, 8]


def test_a_year_is_checked_before_it_is_written_and_read(spark, tmp_path):
    root, cells = str(tmp_path / "s"), spark.createDataFrame(GRID, CELLS)
    with pytest.raises(ValueError, match="full year 2023"):
        products.store_year(cells, root, ["temperature"])
    assert not (tmp_path / "s").exists()
    whole = cells.drop("widx").withColumn("widx", F.explode(F.sequence(F.lit(0), F.lit(45))))
    products.store_year(whole, root, ["temperature"])
    assert products.stored_climatology(spark, root, "temperature", "widx").count() == 46 * 4
    products.store_year(cells.withColumn("year", F.lit(2024)), root, ["temperature"], policy="ignore")
    with pytest.raises(ValueError, match="full year 2024"):
        products.stored_climatology(spark, root, "temperature")


def test_checks_and_policies(spark):
    cells = spark.createDataFrame(GRID, CELLS)
    bad = quality.years_full(cells)
    with pytest.raises(ValueError):
        quality.run_checks([bad], "raise")
    with pytest.warns(UserWarning):
        quality.run_checks([bad], "warn")
    assert quality.run_checks([bad, quality.single_year(cells)], "ignore").count() == 2
    assert quality.windows_have_data(cells.limit(0), "temperature").count() == 0


def test_station_and_surface_files(spark, tmp_path):
    csv = tmp_path / "s.csv"
    csv.write_text("# a\n# b\nyear,month,day,increase since 1800\n2000,1,1,10.0\n2000,1,8,-999.99\n2000,1,15,14.0\n")
    got = readers.station_series(spark, str(csv)).orderBy("d").collect()
    assert [r.x for r in got] == [10.0, 12.0, 14.0]
    txt = tmp_path / "s.txt"
    line = " ".join(f"{300 + k} 0.1" for k in range(41))
    txt.write_text(f"# MBL co2 SURFACE\n# x\n2000.5 {line}\n")
    rows = readers.surface_table(spark, str(txt)).orderBy("k").collect()
    assert len(rows) == 41
    assert (rows[0].lat, rows[20].lat, rows[40].value) == (pytest.approx(-90), pytest.approx(0), 340.0)
    assert str(rows[0].d) == "2000-07-01"
    (tmp_path / "n.txt").write_text("# nothing\n1 2 3\n")
    with pytest.raises(ValueError):
        readers.surface_table(spark, str(tmp_path / "n.txt"))


def test_paths_tables_and_observations(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    assert readers.read_dated(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_dated(spark, [f"{tmp_path}/b"])
    (tmp_path / "o.tsv").write_text("lat\tlon\n1\t2\n")
    assert readers.observations_to_parquet(spark, f"{tmp_path}/o.tsv", f"{tmp_path}/o.parquet", "lat double, lon double").first()[:] == (1.0, 2.0)
    (tmp_path / "k").mkdir()
    (tmp_path / "k/train.csv").write_text("a,b\n1,2\n")
    assert readers.split_table(spark, str(tmp_path), "k", "train", ["a", "b"]).dtypes == [("a", "float"), ("b", "float")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.split_table(spark, str(tmp_path), "k", "test", ["a", "b"])


def test_open_product_clips_renames_and_flags(spark, tmp_path):
    spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2000-01-01', TIMESTAMP_NTZ '2000-01-04')) AS time, 1 AS ilat, 1.5 AS s, 2 AS junk").write.parquet(f"{tmp_path}/p")
    e = [readers.Entry(f"{tmp_path}/p", {"s": "sst"}, None, "2000-01-02", 1), readers.Entry(f"{tmp_path}/p", {"s": "sst"}, "2000-01-03", None, 2)]
    got = readers.open_product(spark, e, "p", ["time", "ilat"], nrt_from="2000-01-04").orderBy("time").collect()
    assert [(r.flag_p, r.is_nrt) for r in got] == [(1, False), (1, False), (2, False), (2, True)]
    assert "junk" not in got[0].asDict()


def test_series_interpolation_and_regression(spark):
    knots = spark.createDataFrame([(0.0, 0.0), (5.0, None), (10.0, 20.0)], "t double, x double")
    asked = spark.createDataFrame([(-1.0,), (0.0,), (2.5,), (10.0,), (11.0,)], "t double")
    assert [r.x for r in co2.at_times(knots, asked, "t", "x").orderBy("t").collect()] == [None, 0.0, 5.0, 20.0, None]
    df = spark.createDataFrame([(0, float(i), 2.0 * i + 1 if i < 5 else None) for i in range(8)], "k int, x double, y double")
    fit = co2.regress(df, "x", "y", ["k"], paired=True).first()
    assert (fit.slope, fit.intercept) == (pytest.approx(2), pytest.approx(1))


def test_smoothing(spark):
    s = spark.createDataFrame([(0, i, x) for i, x in enumerate([0.0, None, None, None, 6.0])], "k int, t int, v double")
    assert [r.v for r in climatology.smooth(s, "v", ["k"], ["t"], 3).orderBy("t").collect()] == [0.0, 0.0, None, 6.0, 6.0]
    cycle = spark.createDataFrame([(0, i, float(i)) for i in range(4)], "k int, t int, v double")
    turned = cycle.withColumn("t", (F.col("t") + 1) % 4)
    a = {r.t: r.v for r in climatology.smooth_cycle(cycle, "v", ["k"], "t").collect()}
    b = {r.t: r.v for r in climatology.smooth_cycle(turned, "v", ["k"], "t").collect()}
    assert b == {(t + 1) % 4: v for t, v in a.items()}


def test_observations_codes_and_scores(spark):
    obs = spark.sql("SELECT TIMESTAMP_NTZ '2000-01-03' AS obs_time, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, CAST(v AS DOUBLE) AS v FROM VALUES (0.1, 359.0, 1), (0.1, -1.0, 3), (50, 0, 9) t(lat, lon, v)")
    got = {(r.ilat, r.ilon): (r.v_mean, r.v_std, r.n) for r in observe.grid(obs, ["v"], 10.0).collect()}
    assert got[(9, 17)] == (2.0, 1.0, 2)
    codes = observe.with_codes(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string"), ["c"])
    assert sorted((r.c or "", -1 if r.c_idx is None else r.c_idx) for r in codes.collect()) == [("", -1), ("a", 0), ("b", 1), ("b", 1)]
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0])], "k int, f array<double>")
    members = [score.member(s, 2) for s in range(3)]
    assert score.predict(df, ["k"], "f", members).count() == 9
    out = {r.k: r for r in score.ensemble(score.predict(df, ["k"], "f", members), ["k"]).collect()}
    assert out[1].members == 3
    assert out[2].members == out[3].members == 0
    import numpy as np

    assert out[1]["mean"] == pytest.approx(np.mean([score.forward(m, np.array([[1.0, 2.0]]))[0] for m in members]))
    perfect = score.fit_metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None)], "a double, b double"), "a", "b").first()
    assert (perfect.r2, perfect.rmse, perfect.n) == (1.0, 0.0, 2)


def test_checks_look_at_each_window_by_itself(spark, tmp_path):
    """A window without some of its cells fails, though the other windows together have them all, and isn't stored."""
    full = [(2000, w, a, o, 1.0) for w in range(2) for a in range(2) for o in range(4)]
    schema = "year int, widx int, ilat int, ilon int, v double"
    whole = spark.createDataFrame(full, schema)
    holed = spark.createDataFrame([r for r in full if r[1:4] != (1, 1, 3) and r[1:4] != (0, 0, 0)], schema)
    rows = lambda df: {r.subject: (r.ok, r.detail) for r in df.collect()}
    assert rows(quality.grid_matches(whole, 90.0)) == {"2000-0": (True, "0,0"), "2000-1": (True, "0,0")}
    assert rows(quality.grid_matches(holed, 90.0)) == {"2000-0": (False, "1,0"), "2000-1": (False, "1,0")}
    other = spark.createDataFrame([*full, (2000, 1, 7, 0, 1.0), (2000, 1, None, 0, 1.0)], schema)
    assert rows(quality.grid_matches(other, 90.0))["2000-1"] == (False, "0,2")
    assert quality.grid_matches(whole.limit(0), 90.0).count() == 0
    row_less = whole.filter("widx = 0 OR ilat = 0")
    assert rows(quality.shape_matches(row_less, 2, 4)) == {"2000-0": (True, "2x4"), "2000-1": (False, "1x4")}
    with pytest.raises(ValueError, match="shape 2000-1"):
        products.store_windows(row_less, str(tmp_path / "s"), ["v"], 2, 4)
    assert not (tmp_path / "s").exists()
    assert products.store_windows(whole, str(tmp_path / "s"), ["v"], 2, 4) == [(2000, 0), (2000, 1)]
    assert store.open_years(spark, str(tmp_path / "s"), "v").count() == len(full)
