import numpy as np
import pytest
from pyspark.sql import functions as F

from gridjobs.operators import fill, regrid, svdfill


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_coarsen_pads_the_border_and_skips_nulls(spark):
    cells = spark.createDataFrame([(0, a, o, None if (a, o) == (0, 0) or a == 4 else float(a * 10 + o)) for a in range(5) for o in range(4)], "w int, ilat int, ilon int, v double")
    got = {(r.ilat, r.ilon): (r.v, r.v_sigma_regrid) for r in regrid.coarsen(cells, ["v"], ["w"], 2).collect()}
    assert len(got) == 6
    assert got[(0, 0)][0] == pytest.approx((1 + 10 + 11) / 3)
    assert got[(0, 0)][1] == pytest.approx(np.std([1, 10, 11]))
    assert got[(2, 0)] == (None, None)
    with pytest.raises(ValueError):
        regrid.coarsen(cells, ["v"], ["w"], 0)


def test_a_constant_and_a_linear_field_are_reproduced(spark):
    cells = spark.createDataFrame([(0, a, o, 3.0, 2.0 * a + 5.0 * o + 1) for a in range(6) for o in range(12)], "w int, ilat int, ilon int, c double, l double")
    axes = [regrid.linear_weights(spark, [i + 0.5 for i in range(n)], [(i + 0.5) * n / m for i in range(m)], *names) for n, m, names in ((6, 9, ("ilat", "jlat", "wlat")), (12, 18, ("ilon", "jlon", "wlon")))]
    got = regrid.interpolate(cells, ["c", "l"], ["w"], *axes).collect()
    assert len(got) == 7 * 16  # outside the outer centres there is nothing
    for r in got:
        assert r.c == pytest.approx(3)
        assert r.l == pytest.approx(2 * ((r.ilat + 0.5) * 6 / 9 - 0.5) + 5 * ((r.ilon + 0.5) * 12 / 18 - 0.5) + 1)


def test_a_null_neighbour_makes_null(spark):
    cells = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, None), (0, 0, 2, 3.0)], "w int, ilat int, ilon int, v double")
    one = spark.createDataFrame([(0, 0, 1.0)], "ilat int, jlat int, wlat double")
    lon = regrid.linear_weights(spark, [0.0, 1.0, 2.0], [0.0, 0.5, 2.0], "ilon", "jlon", "wlon")
    assert [r[3] for r in rows(regrid.interpolate(cells, ["v"], ["w"], one, lon), "ilon")] == [1.0, None, 3.0]


def test_longitude_gaps_cross_the_date_line(spark):
    v = [None, 2.0, 3.0, None, None, None, 7.0, 8.0, None, 10.0, 11.0, None]  # gaps of 1 and 3, and one across the border
    cells = spark.createDataFrame([(0, 0, o, x) for o, x in enumerate(v)], "w int, ilat int, ilon int, v double")
    got = [r[3] for r in rows(regrid.fill_lon_limited(cells, "v", ["w"], 12), "ilon")]
    assert got[11] == pytest.approx(11 - 3)
    assert got[0] == pytest.approx(11 - 6)
    assert got[8] == 9.0
    assert got[3:6] == [4.0, 5.0, None] or got[3:6] == [None, None, None]  # a gap at the turned row's border stays


def test_only_wholly_missing_longitudes_are_filled(spark):
    cells = spark.createDataFrame([(0, a, o, None if o == 11 or (a, o) == (0, 3) else float(o)) for a in range(2) for o in range(12)], "w int, ilat int, ilon int, v double")
    got = {(r.ilat, r.ilon): r.v for r in regrid.fill_lon_gap(cells, "v", ["w"], 12).collect()}
    assert got[(0, 11)] == pytest.approx(5.0)
    assert got[(0, 3)] is None


def test_daily_is_linear_in_time(spark):
    cells = spark.createDataFrame([(0, 0, d, 2.0 * d) for d in (0, 5, 8)], "ilat int, ilon int, day int, v double")
    assert [r[3] for r in rows(regrid.to_daily(cells, "v"), "day")] == pytest.approx([2.0 * d for d in range(9)])


def test_successive_filling(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 2.0, 3.0), (None, None, 3.0), (None, None, None)], "a double, b double, c double")
    got = fill.fill_successively(df, ["a", "b", "c"], "f", "g").select("f", "g").collect()
    assert sorted((r.f or 0, r.g) for r in got) == [(0, 0), (1.0, 1), (2.0, 2), (3.0, 3)]
    with pytest.raises(ValueError):
        fill.fill_successively(df, ["a"], "f", "g")


def test_merge_equals_full_outer_joins(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, a double")
    b = spark.createDataFrame([(2, 20.0), (4, 40.0)], "k int, b double")
    assert rows(fill.merge_products([a, b], ["k"]), "k") == rows(a.join(b, "k", "full"), "k")


def test_fill_nearest_goes_one_step_along_each_axis(spark):
    cells = spark.createDataFrame([(t, 0, 0, {0: 1.0, 4: 5.0}.get(t)) for t in range(6)], "t int, ilat int, ilon int, v double")
    got = fill.fill_nearest(cells, "v", [(["ilat", "ilon"], ["t"])])
    assert [r[3] for r in rows(got, "t")] == [1.0, 1.0, None, 5.0, 5.0, 5.0]


def test_dense_has_every_time_and_cell(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0)], "t int, c int, v double")
    assert rows(fill.dense(cells, ["t"], ["c"]).select("t", "c", "v"), "t", "c") == [(0, 0, 1.0), (0, 1, None), (1, 0, None), (1, 1, 2.0)]


def test_interpolation_by_position(spark):
    s = spark.createDataFrame([(i, x) for i, x in enumerate([None, 1.0, None, 3.0, None])], "d int, x double")
    assert [r[1] for r in rows(fill.interpolate_positions(s, "x", "d"), "d")] == [None, 1.0, 2.0, 3.0, 3.0]


def test_log_state(spark):
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "v double")
    assert fill.log_state(one(-1.0, 2.0), "v")
    assert not fill.log_state(one(0.1, 2.0), "v")
    assert not fill.log_state(one().limit(0), "v")
    with pytest.raises(ValueError):
        fill.log_state(one(-1.0, 20.0), "v")


def test_svd_recovers_a_low_rank_matrix_and_matches_numpy(spark):
    r = np.random.default_rng(0)
    full = r.standard_normal((200, 2)) @ r.standard_normal((2, 10)) + 3
    hidden = r.random(full.shape) < 0.2
    guess = np.tile(full.mean(1, keepdims=True), (1, 10))
    data = [(i, [None if hidden[i, t] else float(full[i, t]) for t in range(10)], [float(x) for x in guess[i]]) for i in range(200)]
    data += [(200 + i, [None] * 10, [None] * 10) for i in range(5)]
    df = spark.createDataFrame(data, "cell int, v array<double>, g array<double>")
    got, errors = svdfill.svd_fill(df, ["cell"], "v", "g", 3, 30)
    out = {x.cell: x.filled for x in got.collect()}
    assert all(x is None for x in out[202])
    x = np.where(hidden, guess, full)
    want = []
    for _ in range(30):
        u, s, v = np.linalg.svd(x, full_matrices=False)
        low = (u[:, :3] * s[:3]) @ v[:3]
        want.append(np.abs((low - full)[~hidden]).mean())
        x = np.where(hidden, low, x)
    assert np.array([out[i] for i in range(200)]) == pytest.approx(x, abs=1e-6)
    assert errors == pytest.approx(want, abs=1e-8)
    assert np.abs(x - full)[hidden].mean() < 0.2 * np.abs(guess - full)[hidden].mean()


def test_chlorophyll_flags(spark):
    df = spark.createDataFrame([(1.0, 1.0, 9.0), (None, 2.0, 9.0), (None, None, 3.0), (None, None, None)], "chl double, near double, filled double")
    assert sorted(r.chl_flag for r in svdfill.chlorophyll(df).collect()) == [0, 1, 2, 3]


def test_target_grid_and_edges(spark):
    g = regrid.target_grid(spark, 30.0)
    assert g.count() == 72
    assert g.agg(F.min("lat"), F.max("lon")).first()[:] == (-75.0, 165.0)
    assert regrid.grid_edges(spark, 30.0).groupBy("axis").count().orderBy("axis").collect()[0]["count"] == 7
