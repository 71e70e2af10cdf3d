"""Gaps filled from the cells beside them, and features of what was observed alone."""

import random

import pytest
from pyspark.sql import functions as F

from gridjobs.jobs import products
from gridjobs.operators import bits, fill, halo, regrid
from gridjobs.sources import store

AXES = [(["a", "o"], "t"), (["t", "o"], "a"), (["t", "a"], "o")]


def cube(spark, share, n=(6, 5, 70), seed=0):
    r = random.Random(seed)
    rows = [(t, a, o, None if r.random() < share else float(100 * t + 10 * a + o), "x") for t in range(n[0]) for a in range(n[1]) for o in range(n[2])]
    return spark.createDataFrame(rows, "t int, a int, o int, v double, note string"), rows


def brute(rows):
    v = {r[:3]: r[3] for r in rows}
    for i in range(3):
        near = lambda k, s: v.get(tuple(x + s * (j == i) for j, x in enumerate(k)))  # noqa: B023, E731
        v = {k: x if x is not None else near(k, -1) if near(k, -1) is not None else near(k, 1) for k, x in v.items()}
    return v


@pytest.mark.parametrize("limit", [halo.LIMIT, 0])
@pytest.mark.parametrize("share", [0.0, 0.05, 0.8, 1.0])
def test_gaps_take_the_value_beside_them_and_all_rows_stay(spark, share, limit):
    df, rows = cube(spark, share)
    got = halo.fill_gaps(df, "v", AXES, limit).collect()
    assert {(r.t, r.a, r.o): r.v for r in got} == brute(rows)
    assert len(got) == len(rows)
    assert {r.note for r in got} == {"x"}


def test_the_result_is_that_of_steps_over_dense_rows(spark):
    df, _ = cube(spark, 0.4, (4, 4, 9), 1)
    both = [{(r.t, r.a, r.o): r.v for r in x.collect()} for x in (halo.fill_gaps(df, "v", AXES), fill.fill_nearest(df, "v", [(p, [at]) for p, at in AXES]))]
    assert both[0] == both[1]


def test_only_neighbours_of_gaps_are_offered(spark):
    df, rows = cube(spark, 0.01, (8, 8, 200), 2)
    gaps = [r for r in rows if r[3] is None]
    wanted = bits.bitmap(df.filter("v IS NULL"), ["t", "a"], "o")
    offered = halo.offers(df.filter("v IS NOT NULL"), "v", ["t", "a"], "o", wanted)
    assert 0 < offered.count() <= 2 * len(gaps) < 0.05 * len(rows)
    plan = offered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_null_keys_repeats_and_no_rows(spark):
    rows = [(0, 0, 1, None), (0, 0, 1, None), (0, 0, 2, 5.0), (0, 0, 2, 4.0), (None, 0, 1, None), (0, None, None, None), (0, 0, -64, None), (0, 0, -65, 7.0)]
    df = spark.createDataFrame(rows, "t int, a int, o int, v double")
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    got = sorted([tuple(r) for r in halo.fill_gaps(df, "v", [(["t", "a"], "o")]).collect()], key=key)
    assert got == sorted([(0, 0, 1, 4.0), (0, 0, 1, 4.0), *rows[2:6], (0, 0, -64, 7.0), rows[7]], key=key)
    assert halo.fill_gaps(df.limit(0), "v", [(["t", "a"], "o")]).count() == 0


def record(spark, root, years=(2020, 2021, 2022)):
    r = random.Random(3)
    rows = [(y, w, a, o, r.random() if r.random() < 0.9 else None, r.random()) for y in years for w in range(46) for a in range(3) for o in range(70)]
    df = spark.createDataFrame(rows, "year int, widx int, ilat int, ilon int, p double, q double").withColumns({v: F.col(v).cast("float") for v in "pq"})
    store.append(df, root, ["p", "q"], states=True)
    return df.withColumns({v: F.col(v).cast("double") for v in "pq"})


def test_features_of_what_was_observed_are_those_of_the_whole_record(spark, tmp_path):
    root = str(tmp_path / "s")
    whole = record(spark, root)
    seen = spark.createDataFrame([(2020, 0, 0, 0, 1.0), (2021, 0, 2, 69, 2.0), (2021, 5, 0, 63, 3.0), (2021, 5, 0, 64, 3.5), (2022, 45, 1, 1, 4.0), (2022, 45, 9, 9, 5.0), (2030, 1, 1, 1, 6.0), (None, 1, 1, 1, 7.0)], "year int, widx int, ilat int, ilon int, m double")
    got = products.stored_training_table(spark, seen, root, ["p", "q"])
    want = products.training_table(seen, whole, ["p", "q"])
    assert sorted(got.columns) == sorted(want.columns)
    a, b = ([tuple(r) for r in df.select(*want.columns).orderBy("m").collect()] for df in (got, want))
    assert len(a) == 5
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y, abs=1e-9)
    # six windows of 138 are opened, and of their rows only those of places with observations go on
    windows, places = {(2021, 0), (2021, 5), (2022, 45)}, bits.bitmap(seen, ["ilat"], "ilon")
    opened = products.stored_features(spark, root, ["p"], places, windows)
    read = {f.split("commit=")[1].split("/", 1)[1].rsplit("/", 1)[0] for f in opened.inputFiles() if "/_states_p/" not in f}
    assert read == {f"year={y}/widx={w}" for y, w in ((2020, 45), (2021, 0), (2021, 4), (2021, 5), (2022, 44), (2022, 45))}
    assert opened.count() == 3 * 5  # five of the places are in the record


def test_without_observations_nothing_of_the_record_is_opened(spark, tmp_path):
    root = str(tmp_path / "s")
    record(spark, root, (2020,))
    none = spark.createDataFrame([], "year int, widx int, ilat int, ilon int, m double")
    got = products.stored_training_table(spark, none, root, ["p"])
    assert got.count() == 0
    assert not [f for f in got.inputFiles() if "/p/commit" in f]
    with pytest.raises(FileNotFoundError):
        products.stored_training_table(spark, none, root, ["absent"])


def test_longitudes_of_all_variables_are_filled_in_one_deal(spark):
    v = [None, 2.0, 3.0, None, 5.0, 6.0]
    df = spark.createDataFrame([(w, a, o, x, None if o == 2 else float(a)) for w in range(3) for a in range(2) for o, x in enumerate(v)], "w int, ilat int, ilon int, x double, y double")
    both = regrid.fill_lon_gap(df, ["x", "y"], ["w"], 6)
    for name in ("x", "y"):
        one = regrid.fill_lon_gap(df, name, ["w"], 6)
        assert sorted(tuple(r) for r in one.select("w", "ilat", "ilon", name).collect()) == sorted(tuple(r) for r in both.select("w", "ilat", "ilon", name).collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert both._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
