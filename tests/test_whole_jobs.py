"""Queries do the whole job on the smallest data."""

import os

import numpy as np
import pytest

from gridjobs.jobs.queries import QUERIES
from gridjobs.operators import svdfill

DATA = "/root/testdata/sf0.001"
with_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@with_data
def test_chlorophyll_is_filled_in_all_years_and_along_all_axes(spark):
    key = ["year", "widx", "ilat", "ilon"]
    got = QUERIES["f4_f5_svd_fill"](spark, DATA).toPandas().set_index(key).sort_index()
    near = QUERIES["w4_f3_fill_nearest"](spark, DATA).toPandas().set_index(key).sort_index()["v"].astype(float)
    assert got.index.equals(near.index)
    some = near.notna()
    assert got["chl_flag"].isin([1, 2]).equals(some)
    assert got["chl_filled"][some].to_numpy(float) == pytest.approx(near[some].to_numpy() / 100, abs=1e-6)


def test_svd_keeps_cells_whose_guess_is_partly_missing(spark):
    """A gap without a guess begins at 0 and ends null, by itself: against the same rounds in numpy."""
    r = np.random.default_rng(5)
    full = r.standard_normal((30, 2)) @ r.standard_normal((2, 7)) + 2
    v = np.where(r.random(full.shape) < 0.3, np.nan, full)
    guess = np.where(r.random(full.shape) < 0.2, np.nan, 2.0)
    guess[3, :2], guess[4] = np.inf, np.nan
    plain = lambda a: [[None if np.isnan(x) else float(x) for x in row] for row in a]
    df = spark.createDataFrame(list(zip(range(30), plain(v), plain(guess), strict=True)), "cell int, v array<double>, g array<double>")
    got = {x.cell: np.array(x.filled, float) for x in svdfill.svd_fill(df, ["cell"], "v", "g", 2, 5)[0].collect()}
    sea, gap = np.arange(30) != 4, np.isnan(v)
    x = np.where(gap, np.nan_to_num(guess, nan=0, posinf=0), v)[sea]
    for _ in range(5):
        u, s, w = np.linalg.svd(x, full_matrices=False)
        x = np.where(gap[sea], u[:, :2] * s[:2] @ w[:2], x)
    x[gap[sea] & ~np.isfinite(guess[sea])] = np.nan
    np.testing.assert_allclose(np.array([got[i] for i in np.flatnonzero(sea)]), x, atol=1e-8)
    assert np.isnan(got[4]).all()


def test_svd_keeps_years_of_different_lengths_apart(spark):
    r = np.random.default_rng(4)
    rows = []
    for year, times in ((1, 9), (2, 6)):
        full = r.standard_normal((40, 2)) @ r.standard_normal((2, times)) + 3
        rows += [(year, i, [None if r.random() < 0.2 else float(x) for x in full[i]], [3.0] * times) for i in range(40)]
    df = spark.createDataFrame(rows, "year int, cell int, v array<double>, g array<double>")
    both = {(x.year, x.cell): x.filled for x in svdfill.svd_fill(df, ["year", "cell"], "v", "g", apart="year")[0].collect()}
    for year in (1, 2):
        for x in svdfill.svd_fill(df.filter(f"year = {year}"), ["year", "cell"], "v", "g")[0].collect():
            assert both[year, x.cell] == pytest.approx(x.filled, abs=1e-9)


def test_svd_work_grows_with_the_rounds_alone(spark, monkeypatch):
    """Writing the cells every few rounds changes nothing, and no round applies more projections than lie between two writes."""
    r = np.random.default_rng(8)
    full = r.standard_normal((50, 2)) @ r.standard_normal((2, 8)) + 1
    rows = [(i, [None if r.random() < 0.25 else float(x) for x in full[i]], [1.0] * 8) for i in range(50)]
    df = spark.createDataFrame(rows, "cell int, v array<double>, g array<double>")
    out, cached = {}, len(spark.sparkContext._jsc.getPersistentRDDs())
    for keep in (1, 3, 99):
        monkeypatch.setattr(svdfill, "KEEP", keep)
        filled, errors = svdfill.svd_fill(df, ["cell"], "v", "g", 2, 10)
        out[keep] = {x.cell: x.filled for x in filled.collect()}, errors
        assert len(errors) == 10
        assert errors[-1] < errors[0]
    for keep in (1, 3):
        assert out[keep][1] == pytest.approx(out[99][1], abs=1e-12)
        for i in range(50):
            assert out[keep][0][i] == pytest.approx(out[99][0][i], abs=1e-9)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached
