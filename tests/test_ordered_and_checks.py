"""Scans over ranges, interval joins, wings, time steps in order and checks in one pass: by brute force, and their plans."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridjobs.functions import calendar
from gridjobs.operators import checks, climatology, co2, fill, intervals, prefix, quality


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def has_single_window(df):
    """Does a window run over all rows in one partition? A scan over one row for each range doesn't count: it stands on an aggregate."""
    under = re.findall(r"Window \[[^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition[^\n]*\n([^\n]*)", plan(df))
    return any("Aggregate" not in line for line in under)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def series(seed, n, share, parts=1):
    r = np.random.default_rng(seed)
    part = np.where(r.random(n) < 0.5, 0, r.integers(0, parts, n))
    t = r.permutation(n)
    return pd.DataFrame({"k": part, "t": t, "v": np.where(r.random(n) < share, np.nan, r.standard_normal(n))})


def rows(spark, pdf):
    plain = [(int(k), int(t), None if np.isnan(v) else float(v)) for k, t, v in pdf.itertuples(index=False)]
    return spark.createDataFrame(plain, "k int, t int, v double").repartition(3)


@pytest.mark.parametrize(("seed", "share", "parts"), [(0, 0.3, 1), (1, 0.97, 1), (2, 0.7, 5), (3, 0.95, 40), (4, 1.0, 2)])
def test_known_around_by_pandas(spark, small_ranges, seed, share, parts):
    pdf = series(seed, 400, share, parts)
    got = prefix.known_around(rows(spark, pdf), "v", ["t"], ["k"], ["t"])
    by = {(r.k, r.t): (r.before and tuple(r.before), r.after and tuple(r.after)) for r in got.collect()}
    assert len(by) == len(pdf)
    for k, own in pdf.sort_values("t").groupby("k"):
        known = [(v, t) for _, t, v in own.itertuples(index=False) if not np.isnan(v)]
        for t in own["t"]:
            assert by[k, t] == (max((x for x in known if x[1] <= t), key=lambda x: x[1], default=None), min((x for x in known if x[1] >= t), key=lambda x: x[1], default=None))
    if parts == 1:
        flat = {r.t: (r.before and r.before.v, r.after and r.after.v) for r in prefix.known_around(rows(spark, pdf), "v", ["t"]).collect()}
        assert flat == {t: (a and a[0], b and b[0]) for (_, t), (a, b) in by.items()}


def test_numbers_and_rolling_frames(spark, small_ranges, monkeypatch):
    monkeypatch.setattr(prefix, "BLOCK", 13)
    pdf = series(7, 300, 0.2).sort_values("t")
    got = {r.t: r.n for r in prefix.numbered(rows(spark, pdf), ["t"], "n").collect()}
    assert got == {t: i for i, t in enumerate(pdf["t"])}
    want = pdf["v"].reset_index(drop=True)
    for _ in range(3):
        want = want.rolling(5, center=True, min_periods=1).mean()
    smooth = climatology.smooth(rows(spark, pdf), "v", [], ["t"], 5, 3)
    np.testing.assert_allclose([r.v for r in smooth.orderBy("t").collect()], want, atol=1e-12)
    assert prefix.numbered(rows(spark, pdf).limit(0), ["t"], "n").count() == 0
    filled = fill.interpolate_positions(rows(spark, pdf), "v", "t").orderBy("t").collect()
    inside = pdf["v"].reset_index(drop=True).interpolate()
    np.testing.assert_allclose([np.nan if r.v is None else r.v for r in filled], inside, atol=1e-12)


def test_no_window_over_all_rows(spark):
    df = rows(spark, series(8, 200, 0.5)).withColumn("x", F.col("t").cast("double"))
    knots = df.select("x", "v")
    asked = df.select((F.col("x") + 0.5).alias("x"))
    for out in (co2.at_times(knots, asked, "x", "v"), fill.interpolate_positions(df, "v", "t"), climatology.smooth(df, "v", [], ["t"]), calendar.steps_per_window(df.select(F.timestamp_seconds("t").alias("time")))):
        assert out.count() >= 1
        assert not has_single_window(out), plan(out)
    assert has_single_window(climatology.smooth(df.withColumn("v", F.row_number().over(Window.orderBy("t"))), "v", ["k"], ["t"]))  # it would be seen


def test_as_of_by_numpy(spark, small_ranges):
    pdf = series(9, 120, 0.4).sort_values("t")
    known = pdf.dropna()
    q = np.concatenate([np.arange(-3, 125, 1.5), known["t"].to_numpy()[:5].astype(float)])
    got = {r.x: r.v for r in co2.at_times(rows(spark, pdf).select(F.col("t").cast("double").alias("x"), "v"), spark.createDataFrame([(float(x),) for x in q], "x double"), "x", "v").collect()}
    want = np.interp(q, known["t"], known["v"], left=np.nan, right=np.nan)
    assert {x: v for x, v in got.items() if v is not None} == pytest.approx({x: v for x, v in zip(q.tolist(), want, strict=True) if not np.isnan(v)})
    assert len(got) == len(set(q.tolist()))


def test_points_in_intervals(spark):
    r = np.random.default_rng(4)
    points = [(i, float(x)) for i, x in enumerate(r.integers(-50, 50, 80))] + [(99, None)]
    spans = [(j, float(a), float(a + n)) for j, (a, n) in enumerate(zip(r.integers(-60, 60, 40), r.integers(0, 30, 40), strict=True))] + [(98, None, 3.0)]
    p, s = spark.createDataFrame(points, "i int, x double"), spark.createDataFrame(spans, "j int, a double, b double")
    want = sorted((i, j) for i, x in points for j, a, b in spans if x is not None and a is not None and a <= x < b)
    for width in (1.0, 7.0, 1000.0):
        got = intervals.within(p, s, "x", "a", "b", width)
        assert sorted((r.i, r.j) for r in got.collect()) == want
    assert "NestedLoop" not in plan(got)
    assert "Cartesian" not in plan(got)


def test_wings_and_window_means_by_numpy(spark):
    days = pd.date_range("1999-12-01", "2000-02-28", freq="5D")
    r = np.random.default_rng(6)
    data = {(t, c): (None if r.random() < 0.15 else float(r.standard_normal())) for t in days for c in range(3) if r.random() > 0.1}
    df = spark.createDataFrame([(str(t), 0, c, v) for (t, c), v in data.items()], "at string, ilat int, ilon int, v double").selectExpr("CAST(at AS TIMESTAMP_NTZ) AS time", "ilat", "ilon", "v")
    windows = [(pd.Timestamp(year=y, month=1, day=1) + pd.Timedelta(days=8 * w), y, w) for y in (1999, 2000) for w in range(46)]
    wings, want = set(), {}
    for s, y, w in windows:
        e = min(s + pd.Timedelta(days=8), pd.Timestamp(year=y + 1, month=1, day=1))
        inside = [t for t in days if s - pd.Timedelta(days=5) <= t < e + pd.Timedelta(days=4)]
        wings |= {(y, w, t) for t in inside}
        for c in range(3):
            means, seen = [], False
            for d in pd.date_range(s, e - pd.Timedelta(days=1)):
                a, b = max((t for t in inside if t <= d), default=None), min((t for t in inside if t >= d), default=None)
                if a is None or b is None:
                    continue
                seen |= (a, c) in data or (b, c) in data
                x, z = data.get((a, c)), data.get((b, c))
                if x is not None and z is not None:
                    means.append(x if a == b else x + (z - x) * ((d - a) / (b - a)))
            if seen:
                want[y, w, c] = (np.mean(means) if means else None, len(means))
    assert {(q.year, q.widx, pd.Timestamp(q.time)) for q in intervals.in_wings(df, "time").collect()} == wings
    got = intervals.window_means(df, "v")
    found = {(q.year, q.widx, q.ilon): (q.v, q.n) for q in got.collect()}
    assert found.keys() == want.keys()
    for k, (v, n) in want.items():
        assert found[k] == (pytest.approx(v), n)
    text = plan(got)
    assert len(re.findall(r"Exchange hashpartitioning\(ilat", text)) <= 2  # the cells travel once (listed twice by an adaptive plan)
    assert "CartesianProduct" not in text
    assert intervals.window_means(df.limit(0), "v").count() == 0


def steps_of(spark, times):
    return spark.createDataFrame([(str(t),) for t in times], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))


def test_time_steps_in_order(spark):
    centers = [r.window_center for r in calendar.windows(spark, 2001, 2002).orderBy("window_center").collect()]
    report = lambda times: {r.subject: (r.ok, r.detail) for r in quality.times_in_order(steps_of(spark, times), "t").collect()}
    full = report(centers)
    assert len(full) == 92
    assert set(full.values()) == {(True, "0")}
    missing = report([c for i, c in enumerate(centers) if i != 10])
    assert missing["2001-9"] == (True, "0")
    assert missing["2001-10"] == (False, str(8 * 86400))  # all later ones of the year move
    assert missing["2001-45"] == (False, "missing")
    assert missing["2002-0"] == (True, "0")
    twice = report([*centers, centers[46 + 20] + pd.Timedelta(minutes=20)])
    assert twice["2002-21"][0] is False
    assert twice["2002-46"] == (False, "surplus")
    assert twice["2001-45"] == (True, "0")
    late = report([c + pd.Timedelta(hours=1) if i == 3 else c for i, c in enumerate(centers)])
    assert [k for k, (ok, _) in late.items() if not ok] == ["2001-3"]  # strictly within
    assert report([]) == {}


GRID = "year int, widx int, ilat int, ilon int, v double"


def odd_grid(spark):
    r = np.random.default_rng(2)
    cells = [(y, w, a, o, None if r.random() < 0.2 or (w == 2 and o == 3) else 1.0) for y in (2000, 2001) for w in range(5) for a in range(6) for o in range(12) if not (w == 1 and a == 2 and o == 7) and not (w == 3 and a == 5)]
    cells += [(2000, 0, 9, 0, 1.0), (2000, 0, None, 0, 1.0), (2000, 0, 0, None, 1.0), (2000, 0, None, None, 1.0), (2000, 4, -1, -70, 1.0), (2000, 4, -1, -70, 1.0), *cells[:40]]
    return spark.createDataFrame(cells, GRID)


def test_checks_in_one_pass_are_those_one_by_one(spark):
    cells = odd_grid(spark)
    got = sorted((r.check, r.subject, r.ok, r.detail) for r in checks.run(cells, checks.named(["grid", "longitudes", "data", "full year", "single year"], "v", 30.0), "ignore").collect())
    apart = [quality.grid_matches(cells, 30.0), quality.longitudes_present(cells, "v", 12), quality.windows_have_data(cells, "v"), quality.years_full(cells), quality.single_year(cells)]
    assert got == sorted((r.check, r.subject, r.ok, r.detail) for d in apart for r in d.collect())
    land = {r.subject: r.ok for r in checks.run(cells.dropDuplicates(["year", "widx", "ilat", "ilon"]), checks.named(["land"], "v", 30.0), "ignore").collect()}
    assert land == {r.subject: r.ok for r in quality.land_is_empty(cells.dropDuplicates(["year", "widx", "ilat", "ilon"]), "v", 30.0).collect()}
    shape = {r.subject: (r.ok, r.detail) for r in checks.run(cells.filter("widx < 4 AND NOT (year = 2000 AND widx = 0)"), checks.named(["shape"], "v", 30.0), "ignore").collect()}
    assert shape["2001-0"] == (True, "6x12")
    assert shape["2001-1"] == (False, "6x12")  # one cell
    assert shape["2001-3"] == (False, "5x12")


def test_checks_read_their_cells_once_and_follow_the_policy(spark, tmp_path):
    cells = odd_grid(spark)
    cells.write.parquet(f"{tmp_path}/cells")
    stored = spark.read.parquet(f"{tmp_path}/cells")
    every = checks.named(list(checks.BY_NAME), "v", 30.0)
    text = plan(checks.facts_of(stored, every))
    assert text.count("FileScan") == 1
    assert "Expand" not in text  # no distinct
    with pytest.raises(ValueError, match="grid 2000-"):
        checks.run(stored, checks.named(["grid"], "v", 30.0))
    with pytest.warns(UserWarning, match="full year 2000"):
        checks.run(stored, checks.named(["full year"], "v", 30.0), "warn")
    with pytest.raises(ValueError, match="unknown checks"):
        checks.named(["grid", "colour"], "v", 30.0)
    assert checks.run(stored.limit(0), checks.named(["grid", "data", "full year"], "v", 30.0)).count() == 0
    wide = spark.range(720 * 1440).selectExpr("2000 AS year", "0 AS widx", "CAST(id DIV 1440 AS INT) AS ilat", "CAST(id % 1440 AS INT) AS ilon", "1.0D AS v")
    assert [(r.check, r.ok) for r in checks.run(wide, checks.named(["grid", "shape", "longitudes"], "v", 0.25)).collect()] == [("grid", True), ("shape", True), ("longitudes", True)]
