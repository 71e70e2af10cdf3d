"""End-to-end jobs: a product's windows, a catalog, gridded observations, features and training table."""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import bounds_status, center, per_year, with_window
from ..functions.cells import count, lat_center, lon_center
from ..operators import bits, checks, climatology, climstate, fill, observe, quality, regrid
from ..sources import manifest, readers, store
from ..sources.shared import written

CELL = ["year", "widx", "ilat", "ilon"]


def product_windows(cells: DataFrame, variables: list[str], factor: int, span: int = 8, time: str = "time") -> DataFrame:
    """All windows of a product at once: block means with spread, stamped with their window's centre."""
    out = regrid.coarsen(with_window(cells, time, span), variables, ["year", "widx"], factor)
    return out.withColumn("window_center", center(F.col("year"), F.col("widx"), span))


def catalog_windows(products: list[DataFrame]) -> DataFrame:
    """The products' windows merged cell by cell."""
    return fill.merge_products(products, CELL)


def store_windows(cells: DataFrame, root: str, variables: list[str], nlat: int, nlon: int, policy: str = "raise") -> list[tuple[int, int]]:
    """Check that the windows have every cell of the grid, then append them by variable."""
    checks.run(cells, {"shape": checks.shape(nlat, nlon)}, policy)
    return store.append(cells, root, variables)


@dataclass(frozen=True)
class Product:
    """A product's cells at its own times and resolution, and how its windows are made.

    factor: cells that are averaged along each axis before the interpolation to the target; time_start, time_end: the product's bounds.
    """

    cells: DataFrame
    variables: list[str]
    source_res: float
    factor: int
    target_res: float
    time: str = "time"
    time_start: str | None = None
    time_end: str | None = None

    @property
    def names(self) -> list[str]:
        """The variables of its windows, spreads among them."""
        plain = regrid.like(self.cells.select(*self.variables))
        return [*self.variables, *[f"{v}_sigma_regrid" for v in self.variables if v not in plain]]


def asked_windows(product: Product, skip: set[tuple[int, int]], span: int, outside: str) -> list[tuple[int, int]]:
    """The product's windows but for those in `skip`. One that isn't within the product's bounds is left out, or an error, as `outside` says."""
    found = with_window(product.cells, product.time, span).select("year", "widx").distinct()
    if product.time_end is not None or product.time_start is not None:
        found = bounds_status(found, product.time_start, product.time_end or "9999-12-31", span)
    else:
        found = found.withColumns({"in_bounds": F.lit(True), "reason": F.lit("within")})
    rows = sorted((r.year, r.widx, r.in_bounds, r.reason) for r in found.collect() if (r.year, r.widx) not in skip)  # a calendar
    late = [f"{y}-{w}: {why}" for y, w, ok, why in rows if not ok]
    if late and outside != "ignore":
        if outside == "raise":
            raise ValueError("; ".join(late[:5]))
        warnings.warn("; ".join(late[:5]), stacklevel=3)
    return [(y, w) for y, w, ok, _ in rows if ok]


def whole_windows(product: Product, windows: list[tuple[int, int]], span: int = 8) -> DataFrame:
    """These windows on the target grid: regridded, a row for every cell of the grid (null where the product has nothing), and longitudes
    that interpolation leaves without any value filled from their neighbours across the date line."""
    spark, res = product.cells.sparkSession, product.target_res
    nlat, nlon = count(180, res), count(360, res)
    wanted = spark.createDataFrame([(i, y, w) for i, (y, w) in enumerate(windows)], "_i long, year int, widx int")
    cells = with_window(product.cells, product.time, span).join(F.broadcast(wanted.drop("_i")), ["year", "widx"], "left_semi")
    got = regrid.regrid(cells, product.variables, ["year", "widx"], product.factor, product.source_res, res)
    n = nlat * nlon
    spine = spark.range(len(windows) * n).select(F.expr(f"id DIV {n}").alias("_i"), F.expr(f"CAST(id % {n} DIV {nlon} AS INT)").alias("ilat"), F.expr(f"CAST(id % {nlon} AS INT)").alias("ilon"))
    spine = spine.join(F.broadcast(wanted), "_i").drop("_i")
    out = regrid.fill_lon_gap(spine.join(got, CELL, "left"), product.names, ["year", "widx"], nlon)
    return out.select(*CELL, *[F.col(v).cast("float").alias(v) for v in product.names])


def checked(cells: DataFrame, names: list[str], res: float, must: list[str], noted: list[str], span: int) -> DataFrame:
    """Reports of all checks of all variables, from one scan: those of `must` are errors where they fail, those of `noted` warnings."""
    own = {}
    for check in (*must, *noted):
        of = names if check in ("longitudes", "data", "land") else names[:1]
        own |= {f"{check} {v}" if len(of) > 1 else check: c for v in of for c in checks.named([check], v, res, span).values()}
    reports = checks.run(cells, own, "ignore")
    named = F.split("check", " ")[0]
    quality.run_checks([reports.filter(named.isin([m.split(" ")[0] for m in must]))], "raise")
    if noted:
        quality.run_checks([reports.filter(named.isin([m.split(" ")[0] for m in noted]))], "warn")
    return reports


def store_product(product: Product, root: str, must: tuple = ("grid", "shape"), noted: tuple = (), span: int = 8, outside: str = "warn", states: bool = False) -> list[tuple[int, int]]:
    """One job from a product to the store: bounds, windows not stored yet, regridding, checks, one commit. Returns the windows appended.

    All windows of the product at once. The regridded windows are written once, since checks and store both read them. Run again
    after a failure it goes on where the store is; run again after success it does nothing.
    """
    spark = product.cells.sparkSession
    now = manifest.load(spark, root)
    stored = set.intersection(*[set(now.windows(v)) for v in product.names])
    windows = asked_windows(product, stored, span, outside)
    if not windows:
        return []
    cells = written(whole_windows(product, windows, span), "windows")
    checked(cells, product.names, product.target_res, list(must), list(noted), span)
    return store.append(cells, root, product.names, span, states)


def store_catalog(products: dict[str, Product], root: str, must: tuple = ("grid", "shape"), noted: tuple = (), span: int = 8, outside: str = "warn") -> list[tuple[int, int]]:
    """The same for a catalog: the products' windows merged cell by cell, and all their variables appended in one commit.

    Variables are named <variable>_<product>. Products without any row are left out; a window that some product lacks is stored with
    nulls for it. All products have the same target grid.
    """
    if len({p.target_res for p in products.values()}) != 1:
        raise ValueError("the products of a catalog share a target grid")
    spark = next(iter(products.values())).cells.sparkSession
    now = manifest.load(spark, root)
    names = [f"{v}_{k}" for k, p in products.items() for v in p.names]
    stored = set.intersection(*[set(now.windows(v)) for v in names])
    parts = []
    for k, p in products.items():
        if windows := asked_windows(p, stored, span, outside):
            own = whole_windows(p, windows, span)
            parts.append(own.select(*CELL, *[F.col(v).alias(f"{v}_{k}") for v in p.names]))
    if not parts:
        return []
    cells = written(fill.merge_products(parts, CELL), "windows")
    for v in names:
        if v not in cells.columns:
            cells = cells.withColumn(v, F.lit(None).cast("float"))
    checked(cells, names, next(iter(products.values())).target_res, list(must), list(noted), span)
    return store.append(cells, root, names, span)


def kept_climatology(spark: SparkSession, root: str, variable: str) -> DataFrame:
    """Climatology and seasonal anomaly of a stored variable from the sums that its appends have kept: the record isn't read."""
    state = store.read_state(spark, root, variable)
    return climatology.seasonal_anomaly(climstate.climatology(state, [variable]), climstate.long_term_mean(state, [variable]), [variable]).join(climstate.climatology(state, [variable]), ["ilat", "ilon", "season_key"])


def store_year(cells: DataFrame, root: str, variables: list[str], overwrite: bool = False, policy: str = "raise") -> None:
    """Check that the year has all its windows, then write it."""
    quality.run_checks([quality.years_full(cells)], policy)
    store.write_year(cells, root, variables, overwrite)


def stored_climatology(spark: SparkSession, root: str, variable: str, key: str = "dayofyear") -> DataFrame:
    """The seasonal climatology of a stored variable; a year that lacks windows is an error."""
    return climatology.climatology(store.open_years(spark, root, variable, quality.years_full), [variable], key)


def gridded_observations(obs: DataFrame, measures: list[str], res: float, since: int = 1982) -> DataFrame:
    """Observations since a year (filtered before the shuffle), gridded, with their window's centre."""
    recent = obs.filter(F.col("obs_time") >= F.lit(f"{since}-01-01").cast("timestamp_ntz"))
    return observe.grid(recent, measures, res).withColumn("window_center", center(F.col("year"), F.col("widx")))


def observation_job(spark: SparkSession, tsv: str, folder: str, schema: str, names: dict[str, str], categories: list[str], res: float, since: int = 1982, time: str = "obs_time", ddof: int = 0) -> DataFrame:
    """From tab-separated observations to a table of gridded ones: as Parquet, categories coded, gridded, written by year, read again.

    names: measure -> its name in the result, where it becomes <name>_mean and <name>_std; of each category, the number of different
    codes of a cell becomes <category>_n. The whole record is gridded and written below `folder`, in one rename at the end, so a job
    that failed is run again as it is; the result reads the years from `since` on alone. Observations without time or place have no cell.
    """
    flat = readers.observations_to_parquet(spark, tsv, f"{folder}/observations", schema)
    placed = flat.dropna(subset=[time, "lat", "lon"])
    spread = F.stddev_samp if ddof else F.stddev_pop
    out = [f(m).alias(f"{n}_{s}") for m, n in names.items() for f, s in ((F.avg, "mean"), (spread, "std"))]
    gridded = observe.with_cells(placed, res, time).groupBy(*CELL).agg(*out, F.count("*").alias("n"))
    if categories:
        coded = observe.with_cells(observe.with_codes(placed.select(time, "lat", "lon", *categories), categories), res, time)
        different = observe.different(coded, CELL, {f"{c}_n": f"{c}_idx" for c in categories}, flat.count())
        gridded = fill.merge_products([gridded, different], CELL).withColumns({f"{c}_n": F.coalesce(f"{c}_n", F.lit(0)) for c in categories})
    files, beside = manifest.Folder(spark, folder), f".gridded-{uuid.uuid4().hex}"
    gridded.repartition("year").write.partitionBy("year").parquet(f"{folder}/{beside}")
    files.delete("gridded")
    if not files.rename(beside, "gridded"):
        raise RuntimeError(f"{folder}: another job has written its cells")
    return gridded_table(spark, folder, gridded.schema, res, since)


def gridded_table(spark: SparkSession, folder: str, schema, res: float, since: int = 1982) -> DataFrame:
    """The stored cells of a year and later, by time, lat and lon of their centres; earlier years' files aren't read."""
    got = spark.read.schema(schema).parquet(f"{folder}/gridded").filter(F.col("year") >= since)
    return got.select(center(F.col("year"), F.col("widx")).alias("time"), lat_center(F.col("ilat"), res).alias("lat"), lon_center(F.col("ilon"), res).alias("lon"), *[c for c in got.columns if c not in CELL])


def training_table(observed: DataFrame, cells: DataFrame, variables: list[str]) -> DataFrame:
    """Gridded observations beside the features of their cell and window."""
    return observe.colocate(observed, climatology.features(cells, variables))


def stored_features(spark: SparkSession, root: str, variables: list[str], places: DataFrame, windows: set[tuple[int, int]], span: int = 8) -> DataFrame:
    """The features of some places in some windows, from the store and the sums that its appends have kept.

    places: a set of cells as bits (operators/bits.py), at most a row for each 64 cells of the grid. Of the record, only the files
    of the windows and of those just before them are opened, and only the places' rows go on; climatologies come from the sums.
    Values are doubles of the stored floats; a cell that isn't stored in a window has no row there.
    """
    now, per = manifest.load(spark, root), per_year(span)
    before = {divmod(y * per + w - 1, per) for y, w in windows}
    of = {v: bits.within(store.opened(spark, root, v, now, windows=windows | before), places, ["ilat"], "ilon").withColumn(v, F.col(v).cast("double")) for v in variables}
    cells = fill.merge_products(list(of.values()), CELL) if len(of) > 1 else of[variables[0]]
    out = climatology.deltas(cells, variables, span)
    for v in variables:
        state = bits.within(store.read_state(spark, root, v, now), places, ["ilat"], "ilon")
        clim = climstate.climatology(state, [v]).join(climstate.long_term_mean(state, [v]), climatology.CELL)
        out = out.join(clim.withColumnRenamed("season_key", "widx"), [*climatology.CELL, "widx"], "left")
    named = {"anom": lambda v: F.col(v) - F.col(f"clim_{v}"), "seas": lambda v: F.col(f"clim_{v}") - F.col(f"ltm_{v}"), "delta": lambda v: F.col(f"delta_{v}"), "clim": lambda v: F.col(f"clim_{v}")}
    asked = spark.createDataFrame(sorted(windows), "year int, widx int")
    return out.join(F.broadcast(asked), ["year", "widx"], "left_semi").select(*CELL, *[named[p](v).alias(f"{p}_{v}") for v in variables for p in ("anom", "delta", "clim", "seas")])


def stored_training_table(spark: SparkSession, observed: DataFrame, root: str, variables: list[str], span: int = 8) -> DataFrame:
    """Gridded observations beside the stored features of their cell and window; the work on the record follows what was observed.

    The observations are written once. Their windows, a calendar, say which files are opened, and their places as bits which rows of these go
    on to the join. Without any observation nothing of the record is read. Cells that the store lacks have no row.
    """
    observed = written(observed, "observed")
    windows = {(r.year, r.widx) for r in observed.select("year", "widx").dropna().distinct().collect()}
    if not windows:
        windows = {(-1, 0)}  # no window of a store
    return observe.colocate(observed, stored_features(spark, root, variables, bits.bitmap(observed, ["ilat"], "ilon"), windows, span))
