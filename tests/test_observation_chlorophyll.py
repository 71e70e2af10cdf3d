"""The observation job from text to a table, and chlorophyll filling as one operator."""

import math

import numpy as np
import pytest

from gridjobs.jobs import products
from gridjobs.operators import svdfill
from gridjobs.sources import manifest

SCHEMA = "ship string, obs_time timestamp_ntz, lat double, lon double, f double, flag string"
HEAD = "ship\tobs_time\tlat\tlon\tf\tflag"
ROWS = ["A\t1981-12-30 00:00:00\t0.5\t0.5\t1.0\tx", "A\t1982-01-01 00:00:00\t0.5\t0.5\t2.0\tx", "B\t1982-01-08 23:00:00\t0.9\t0.1\t4.0\tx", "A\t1982-01-02 00:00:00\t0.5\t359.5\t\ty", "\t1990-06-01 00:00:00\t-0.5\t-0.5\t7.0\t", "B\t\t1.5\t0.5\t9.0\tx"]


def job(spark, tmp_path, rows=ROWS, **more):
    (tmp_path / "o.tsv").write_text("\n".join([HEAD, *rows]) + "\n")
    return products.observation_job(spark, str(tmp_path / "o.tsv"), str(tmp_path / "out"), SCHEMA, {"f": "fco2"}, ["ship", "flag"], 1.0, **more)


def test_observations_from_text_to_a_table(spark, tmp_path):
    got = {(str(r.time)[:10], r.lat, r.lon): tuple(r)[3:] for r in job(spark, tmp_path).collect()}
    assert got == {("1982-01-05", 0.5, 0.5): (3.0, 1.0, 2, 2, 1), ("1982-01-05", 0.5, -0.5): (None, None, 1, 1, 1), ("1990-05-29", -0.5, -0.5): (7.0, 0.0, 1, 0, 0)}
    assert len(job(spark, tmp_path, since=1900).collect()) == 4  # run again; the record is stored whole


def test_years_before_the_first_asked_for_are_not_read(spark, tmp_path):
    plan = job(spark, tmp_path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert (tmp_path / "out/gridded/year=1981").is_dir()


def test_a_job_that_fails_in_the_rename_is_run_again(spark, tmp_path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(manifest.Folder, "rename", lambda *_: False)
        with pytest.raises(RuntimeError):
            job(spark, tmp_path)
    assert job(spark, tmp_path).count() == 3
    assert job(spark, tmp_path, []).count() == 0  # no observations


def years(spark, f, n=4, cells=6):
    rows = [(y, w, a, o, f(y, w, a, o)) for y in (1, 2) for w in range(n) for a in range(2) for o in range(cells // 2)]
    return spark.createDataFrame(rows, "year int, widx int, ilat int, ilon int, chl double")


def guess(spark, value=-0.5, n=4):
    return spark.createDataFrame([(a, o, w, value) for w in range(n) for a in range(2) for o in range(3)], "ilat int, ilon int, widx int, clim_chl double")


def test_chlorophyll_is_brought_to_log10_and_filled_with_flags(spark):
    gap = lambda y, w, a, o: None if (y, w) == (1, 0) and (a, o) == (0, 0) or y == 2 else 0.001 if o == 1 else 0.1 * (w + 1) + a
    got = {tuple(r)[:4]: (r.chl_filled, r.chl_flag) for r in svdfill.fill_chlorophyll(years(spark, gap), guess(spark), convert=True, rank=1, rounds=2).collect()}
    assert len(got) == 48
    assert got[1, 1, 1, 2] == (pytest.approx(math.log10(1.2)), 1)
    assert got[1, 1, 1, 1] == (pytest.approx(math.log10(5e-3)), 1)
    assert got[1, 0, 0, 0] == (pytest.approx(math.log10(0.2)), 2)
    # the second year has its first window from the last of the year before; the rest of it is a matrix of its own
    assert got[2, 0, 0, 0] == (pytest.approx(math.log10(0.4)), 2)
    v = np.array([[math.log10(0.4 + a) if o != 1 else math.log10(5e-3)] + [np.nan] * 3 for a in range(2) for o in range(3)])
    hole, x = np.isnan(v), np.where(np.isnan(v), -0.5, v)
    for _ in range(2):
        u, s, w = np.linalg.svd(x, full_matrices=False)
        x = np.where(hole, u[:, :1] * s[:1] @ w[:1], x)
    for i, (a, o) in enumerate((a, o) for a in range(2) for o in range(3)):
        for t in (1, 2, 3):
            assert got[2, t, a, o] == (pytest.approx(x[i, t], abs=1e-9), 3)


def test_chlorophyll_of_another_scale_or_shape_is_an_error(spark):
    logged, plain = years(spark, lambda *_: -0.7), years(spark, lambda *_: 0.2)
    fill = lambda c, g, **k: svdfill.fill_chlorophyll(c, g, rank=1, rounds=1, **k)
    assert fill(logged, guess(spark)).count() == 48
    for cells, clim, more, said in (
        (plain, guess(spark), {}, "cells aren't in log10"),
        (logged, guess(spark, 0.3), {}, "climatology isn't in log10"),
        (years(spark, lambda *_: -20.0).union(years(spark, lambda *_: 20.0)), guess(spark), {"convert": True}, "negative"),
        (logged.filter("NOT (year = 2 AND widx = 3 AND ilat = 1)"), guess(spark), {}, "year 2 has 21"),
        (logged.union(logged.filter("year = 1 AND widx = 0")), guess(spark), {}, "year 1 has 30"),
        (logged, guess(spark, n=5), {}, "has 30 windows"),
        (logged, guess(spark).union(guess(spark)), {}, "key twice"),
    ):
        with pytest.raises(ValueError, match=said):
            fill(cells, clim, **more)


def test_codes_are_counted_apart_from_the_sums(spark, tmp_path, monkeypatch):
    """Codes travel without the sums' buffers, and are dealt to tasks of a bounded number before copies are dropped."""
    import gridjobs.jobs.products as p

    seen, merge = [], p.fill.merge_products
    monkeypatch.setattr(p.fill, "merge_products", lambda parts, keys: seen.extend(parts) or merge(parts, keys))
    monkeypatch.setattr(p.observe, "DEALT", 100)
    rows = [f"S{i % 7}\t1990-06-0{1 + i % 2} 00:00:00\t{0.5 + i % 2}\t0.5\t{i}.0\t{'x' if i % 3 else ''}" for i in range(600)]
    got = {r.lat: (r.n, r.ship_n, r.flag_n) for r in job(spark, tmp_path, rows).collect()}
    assert got == {0.5: (300, 7, 1), 1.5: (300, 7, 1)}
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in seen]
    assert len(plans) == 2
    assert not any("Expand" in x for x in plans)
    assert "avg" in plans[0]
    assert "avg" not in plans[1]
    assert "REPARTITION_BY_NUM" in plans[1]
    assert ", 13)" in plans[1]  # 1,200 values, 100 a task
    alone = job(spark, tmp_path, ["A\t1990-06-01 00:00:00\t0.5\t0.5\t1.0\t"])
    assert [tuple(r)[3:] for r in alone.collect()] == [(1.0, 0.0, 1, 1, 0)]
