"""The store's versions: all of a commit or nothing, whatever fails on the way; jobs from products to the store."""

import pytest
from pyspark.sql import functions as F

from gridjobs.jobs import products
from gridjobs.operators import climatology, climstate, fill
from gridjobs.sources import manifest, store

CELLS = "year int, widx int, ilat int, ilon int, t double, u double"


def window(spark, *at, t=1.0):
    return spark.createDataFrame([(y, w, a, o, t + a, None if o else t) for y, w in at for a in range(2) for o in range(2)], CELLS)


def held(spark, root, variables=("t", "u")):
    return {v: sorted({(r.year, r.widx) for r in store.open_years(spark, root, v).collect()}) for v in variables}


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["second variable", "before the manifest", "in the rename", "after the rename"])
def test_a_job_that_is_killed_leaves_all_of_a_commit_or_nothing(spark, tmp_path, monkeypatch, where):
    root, both = str(tmp_path / "s"), ["t", "u"]
    store.append(window(spark, (2023, 0)), root, both)
    late = window(spark, (2023, 0), (2023, 1), (2023, 2))

    def kill(*_):
        raise Killed(where)

    with monkeypatch.context() as m:
        if where == "second variable":
            broken = late.withColumn("u", F.raise_error(F.lit(where)).cast("double"))
            with pytest.raises(Exception, match=where):
                store.append(broken, root, both)
        else:
            publish = manifest.publish
            if where == "before the manifest":
                m.setattr(manifest, "publish", kill)
            elif where == "in the rename":
                m.setattr(manifest.Folder, "rename", kill)
            else:
                m.setattr(manifest, "publish", lambda *a: (publish(*a), kill()))
            with pytest.raises(Killed):
                store.append(late, root, both)
    done = where == "after the rename"
    want = [(2023, 0), (2023, 1), (2023, 2)] if done else [(2023, 0)]
    assert held(spark, root) == {"t": want, "u": want}
    assert store.append(late, root, both) == ([] if done else [(2023, 1), (2023, 2)])  # the same append again
    assert held(spark, root) == {"t": [(2023, 0), (2023, 1), (2023, 2)], "u": [(2023, 0), (2023, 1), (2023, 2)]}
    assert store.open_years(spark, root, "t").count() == 12
    gone = manifest.vacuum(spark, root)
    assert len(gone) == {"second variable": 0, "after the rename": 0}.get(where, 2)  # the folders of both variables; rows that fail are made before any is written
    assert store.open_store(spark, root, both).count() == 12


def test_a_year_is_swapped_in_one_step(spark, tmp_path, monkeypatch):
    root, both = str(tmp_path / "s"), ["t", "u"]
    store.write_year(window(spark, (2022, 0), (2022, 1)), root, both)
    store.write_year(window(spark, (2023, 0), (2023, 1)), root, both)
    before = manifest.load(spark, root).version
    new = window(spark, (2022, 0), t=50.0)
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(manifest, "publish", lambda *_: (_ for _ in ()).throw(Killed()))
        store.write_year(new, root, both, overwrite=True)
    assert store.open_years(spark, root, "t").agg(F.max("t")).first()[0] == 2.0
    store.write_year(new, root, both, overwrite=True)
    assert held(spark, root) == {"t": [(2022, 0), (2023, 0), (2023, 1)], "u": [(2022, 0), (2023, 0), (2023, 1)]}
    assert store.open_years(spark, root, "t").filter("year = 2022").agg(F.min("t")).first()[0] == 50.0
    old = store.open_years(spark, root, "t", version=before)  # a version of before
    assert old.filter("year = 2022").count() == 8
    assert old.agg(F.max("t")).first()[0] == 2.0
    with pytest.raises(FileNotFoundError, match="version 99"):
        manifest.load(spark, root, 99)


def test_writers_that_meet_and_variables_that_are_behind(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    store.append(window(spark, (2023, 0)), root, ["t", "u"])
    publish = manifest.publish
    with monkeypatch.context() as m:

        def second(*a):
            m.setattr(manifest, "publish", publish)
            store.append(window(spark, (2023, 1)), root, ["t"])  # another writer is faster
            publish(*a)

        m.setattr(manifest, "publish", second)
        with pytest.raises(RuntimeError, match="another writer"):
            store.append(window(spark, (2023, 1)), root, ["t", "u"])
    assert held(spark, root) == {"t": [(2023, 0), (2023, 1)], "u": [(2023, 0)]}
    assert store.append(window(spark, (2023, 1), (2023, 2)), root, ["t", "u"]) == [(2023, 1), (2023, 2)]
    assert held(spark, root)["u"] == [(2023, 0), (2023, 1), (2023, 2)]
    with pytest.raises(FileNotFoundError, match="no x"):
        store.open_years(spark, root, "x")
    with pytest.raises(ValueError, match="follow"):
        store.append(window(spark, (2023, 5)), root, ["t", "u"])
    assert store.append(window(spark).limit(0), root, ["t"]) == []


def test_only_years_that_are_asked_for_are_read(spark, tmp_path):
    root = str(tmp_path / "s")
    for y in (2021, 2022, 2023):
        store.write_year(window(spark, (y, 0)), root, ["t"])
    df = store.open_years(spark, root, "t").filter("year = 2022")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert len({r.f for r in df.select(F.input_file_name().alias("f")).collect()}) == 1


def test_sums_grow_with_the_store(spark, tmp_path):
    """Climatologies of the sums equal those of the record after each append, and read nothing else."""
    root, all_ = str(tmp_path / "s"), []
    for year in (2020, 2021, 2022):
        all_ += [(year, w) for w in range(46)]
        cells = window(spark, *all_, t=float(year)).withColumn("t", F.col("t") * (F.col("widx") + 1) + F.col("year"))
        store.append(cells.filter(F.col("year") == year), root, ["t", "u"], states=True) if year > 2020 else store.append(cells, root, ["t"], states=True)
        if year == 2020:
            store.append(cells, root, ["u"])  # without sums: they are made from the record when they are first asked for
        for v in ("t", "u"):
            if v not in manifest.load(spark, root).states:
                continue
            record = store.open_years(spark, root, v)
            want = {tuple(r[:3]): r[3] for r in climatology.climatology(record, [v], "widx").collect()}
            state = store.read_state(spark, root, v)
            assert {tuple(r[:3]): r[3] for r in climstate.climatology(state, [v]).collect()} == pytest.approx(want, nan_ok=True)
            ltm = {tuple(r[:2]): r[2] for r in climatology.long_term_mean(record, [v]).collect()}
            assert {tuple(r[:2]): r[2] for r in climstate.long_term_mean(state, [v]).collect()} == pytest.approx(ltm)
    scans = products.kept_climatology(spark, root, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "widx" not in scans
    store.append(window(spark, (2023, 0)), root, ["t"])  # sums that aren't carried on are out of date, and gone
    with pytest.raises(FileNotFoundError, match="no sums of t"):
        products.kept_climatology(spark, root, "t")
    assert "u" in manifest.load(spark, root).states
    store.append(window(spark, (2023, 1)), root, ["t"], states=True)  # begun anew from the record
    assert store.read_state(spark, root, "t").agg(F.sum("n_t")).first()[0] == store.open_years(spark, root, "t").filter("t IS NOT NULL").count()


def product(spark, windows, hole=False, **more):
    """A field of 30 degrees twice in each window."""
    rows = [(f"{y}-01-0{1 + 2 * k} 00:00:00" if w == 0 else f"{y}-01-1{k} 00:00:00", a, o, float(10 * a + o + w + k)) for y, w in windows for k in range(2) for a in range(6) for o in range(12) if not (hole and (w, o) == (1, 3))]
    cells = spark.createDataFrame(rows, "at string, ilat int, ilon int, v double").selectExpr("CAST(at AS TIMESTAMP_NTZ) AS time", "ilat", "ilon", "v")
    return products.Product(cells, ["v"], 30.0, 1, 30.0, **more)


def test_a_product_goes_to_the_store_once(spark, tmp_path):
    root = str(tmp_path / "p")
    assert products.store_product(product(spark, [(2000, 0)]), root) == [(2000, 0)]
    p = product(spark, [(2000, 0), (2000, 1)], hole=True)
    with pytest.raises(ValueError, match="data"):  # window 1 of an unknown year? no: of 2000, of which 44 windows lack data
        products.store_product(p, root, must=("grid", "data"))
    assert held(spark, root, ["v"]) == {"v": [(2000, 0)]}
    with pytest.warns(UserWarning, match="full year"):
        assert products.store_product(p, root, noted=("full year", "longitudes")) == [(2000, 1)]
    assert products.store_product(p, root) == []
    got = {(r.widx, r.ilat, r.ilon): r.v for r in store.open_years(spark, root, "v").collect()}
    assert len(got) == 2 * 72
    assert got[0, 2, 5] == 25.5
    assert got[1, 2, 3] == pytest.approx((got[1, 2, 2] + got[1, 2, 4]) / 2)  # a longitude without values is filled


def test_bounds_and_unknown_checks(spark, tmp_path):
    root = str(tmp_path / "p")
    p = product(spark, [(2000, 0), (2000, 1)], time_end="2000-01-12")
    with pytest.raises(ValueError, match="2000-1: after the end"):
        products.store_product(p, root, outside="raise")
    with pytest.warns(UserWarning, match="after the end"):
        assert products.store_product(p, root) == [(2000, 0)]
    with pytest.raises(ValueError, match="unknown checks"):
        products.store_product(product(spark, [(2000, 1)]), root, must=("colour",))


def test_a_catalog_is_one_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    both = {"a": product(spark, [(2000, 0), (2000, 1)]), "b": product(spark, [(2000, 0)]), "none": product(spark, [])}
    names = ["v_a", "v_sigma_regrid_a", "v_b", "v_sigma_regrid_b", "v_none", "v_sigma_regrid_none"]
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(manifest.Folder, "rename", lambda *_: (_ for _ in ()).throw(Killed()))
        products.store_catalog(both, root)
    assert manifest.load(spark, root).version == 0
    assert products.store_catalog(both, root) == [(2000, 0), (2000, 1)]
    assert manifest.load(spark, root).version == 1
    got = {(r.widx, r.ilat, r.ilon): r for r in store.open_store(spark, root, names).collect()}
    assert len(got) == 144
    assert (got[0, 1, 1].v_a, got[0, 1, 1].v_b, got[1, 1, 1].v_b, got[0, 1, 1].v_none) == (11.5, 11.5, None, None)
    assert products.store_catalog(both, root) == []
    with pytest.raises(ValueError, match="target grid"):
        products.store_catalog({"a": both["a"], "b": products.Product(both["a"].cells, ["v"], 30.0, 1, 60.0)}, root)


def test_a_holed_window_is_refused(spark, tmp_path):
    """A window of 2 x 4 that lacks one cell has all latitudes and longitudes, and isn't stored."""
    full = [(2000, w, a, o, 1.0) for w in range(2) for a in range(2) for o in range(4)]
    holed = spark.createDataFrame([r for r in full if r[1:4] != (1, 1, 3)], "year int, widx int, ilat int, ilon int, v double")
    with pytest.raises(ValueError, match="shape 2000-1: 2x4"):
        products.store_windows(holed, str(tmp_path / "s"), ["v"], 2, 4)
    assert not (tmp_path / "s").exists()


def test_merged_products_have_unique_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, b double")
    assert sorted(tuple(r) for r in fill.merge_products([a, b], ["k"]).collect()) == [(1, 1.0, None), (2, 2.0, 5.0), (3, None, 6.0)]
    with pytest.raises(Exception, match="key twice: 2"):
        fill.merge_products([a, b.union(b.limit(1))], ["k"]).count()
