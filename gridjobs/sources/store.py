"""A dataset of Parquet for each variable, in partitions of commit, year and window; a manifest says which of them are the store."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import per_year
from ..operators import climstate, quality
from ..operators.fill import merge_products
from . import manifest
from .manifest import Manifest

KEYS = ["year", "widx", "ilat", "ilon"]


def stored_windows(spark: SparkSession, root: str, variables: list[str]) -> DataFrame:
    """variable, year, widx of what is stored, from the manifest alone."""
    now = manifest.load(spark, root)
    return spark.createDataFrame([(v, y, w) for v in variables for y, w in now.windows(v)], "variable string, year int, widx int")


def write_commit(part: DataFrame, root: str, commit: str, variables: list[str], wanted: dict[str, set]) -> dict[str, dict]:
    """Write each variable's windows under the commit and count their rows in what was written. Nothing of it is in the store yet.

    Every window is one task's and one file. A variable whose rows aren't all there again, or one of whose windows is empty, is an error.
    """
    spark, added = part.sparkSession, {}
    part = part.repartition("year", "widx").persist(StorageLevel.DISK_ONLY)
    try:
        for v in variables:
            windows = spark.createDataFrame(sorted(wanted[v]), "year int, widx int")
            path = f"{root}/{v}/commit={commit}"
            part.join(F.broadcast(windows), ["year", "widx"], "left_semi").select(*KEYS, F.col(v).cast("float").alias(v)).write.partitionBy("year", "widx").parquet(path)
            found = {(r.year, r.widx): (commit, r["count"]) for r in spark.read.parquet(path).groupBy("year", "widx").count().collect()}
            if set(found) != wanted[v]:
                raise OSError(f"{v}: windows {sorted(wanted[v] - set(found))[:5]} weren't written")
            added[v] = found
    finally:
        part.unpersist()
    counts = {v: sum(n for _, n in found.values()) for v, found in added.items()}
    if len({frozenset(w) for w in wanted.values()}) == 1 and len(set(counts.values())) > 1:
        raise OSError(f"the variables have unlike numbers of rows: {counts}")
    return added


def append(cells: DataFrame, root: str, variables: list[str], span: int = 8, states: bool = False) -> list[tuple[int, int]]:
    """Append the windows of cells that follow what is stored, each variable to its own dataset; returns them.

    Windows that are stored already are left out; one that doesn't follow its predecessor is an error, before anything is written.
    All variables are written first and become part of the store together, by one rename of the manifest: a failure before it
    leaves the store as it was, and the same append again writes what is missing. states: keep the sums for climatologies too.
    """
    spark = cells.sparkSession
    now = manifest.load(spark, root)
    asked = sorted((r.year, r.widx) for r in cells.select("year", "widx").distinct().collect())  # a calendar: some thousand windows
    have = {v: set(now.windows(v)) for v in variables}
    wanted = {v: {w for w in asked if w not in have[v]} for v in variables}
    per = per_year(span)
    for v in variables:
        last = max(have[v], default=None)
        for y, w in sorted(wanted[v]):
            if last is None and w:
                raise ValueError(f"{v}: an empty store begins with a year's first window, not {y}-{w}")
            if last is not None and (y * per + w) - (last[0] * per + last[1]) != 1:
                raise ValueError(f"{v}: window {y}-{w} doesn't follow {last[0]}-{last[1]}")
            last = (y, w)
    new = [v for v in variables if wanted[v]]
    if not new:
        return []
    commit = uuid.uuid4().hex
    added = write_commit(cells, root, commit, new, wanted)
    of = {}
    if states:
        fresh = [v for v in new if v not in now.states and now.windows(v)]  # sums that were never kept are made from the whole variable, once
        for v in new:
            own = spark.read.parquet(f"{root}/{v}/commit={commit}")
            before = climstate.state(open_years(spark, root, v), [v]) if v in fresh else read_state(spark, root, v, now) if v in now.states else None
            of[v] = climstate.state(own, [v]) if before is None else climstate.merged([before, climstate.state(own, [v])], [v])
    write_states(of, root, commit)
    kept = {v: c for v, c in now.states.items() if v not in new} | dict.fromkeys(of, commit)  # sums that this commit doesn't carry on are out of date
    manifest.publish(spark, root, now.following(commit, added, states=kept))
    return sorted(set().union(*wanted.values()))


def write_year(cells: DataFrame, root: str, variables: list[str], overwrite: bool = False) -> None:
    """Write one whole year of all variables. A year that is there is an error, or is replaced, in one step; other years stay."""
    years = [r.year for r in cells.select("year").distinct().limit(2).collect()]
    if len(years) != 1:
        raise ValueError("one year at a time")
    spark, year = cells.sparkSession, years[0]
    now = manifest.load(spark, root)
    for v in variables:
        if not overwrite and any(y == year for y, _ in now.windows(v)):
            raise ValueError(f"{v}: year {year} is stored")
    windows = {(r.year, r.widx) for r in cells.select("year", "widx").distinct().collect()}
    commit = uuid.uuid4().hex
    added = write_commit(cells, root, commit, variables, dict.fromkeys(variables, windows))
    kept = {v: c for v, c in now.states.items() if v not in variables}
    manifest.publish(spark, root, now.following(commit, added, dict.fromkeys(variables, year), kept))


def open_years(spark: SparkSession, root: str, variable: str, check: Callable[[DataFrame], DataFrame] | None = None, version: int | None = None) -> DataFrame:
    """All years of a variable, in the newest version or one of before; check gets the table and returns a report whose failures are errors.

    Only folders that the manifest names are read: a commit's whole folder where all of it is live, else its windows' folders.
    """
    now = manifest.load(spark, root, version)
    return opened(spark, root, variable, now, check)


def opened(spark: SparkSession, root: str, variable: str, now: Manifest, check=None, windows: set[tuple[int, int]] | None = None) -> DataFrame:
    """A variable in a version; windows: only those of it are opened that are in this set, so no other file is listed or read."""
    own, schema = now.entries.get(variable), f"ilat int, ilon int, {variable} float, commit string, year int, widx int"
    if not own:
        raise FileNotFoundError(f"{root} has no {variable}")
    if windows is not None:
        own = {k: x for k, x in own.items() if k in windows}
        if not own:
            return spark.createDataFrame([], schema).select(*KEYS, variable)
    by_commit: dict[str, set] = {}
    for (y, w), (c, _) in own.items():
        by_commit.setdefault(c, set()).add((y, w))
    paths = []
    for c, held in sorted(by_commit.items()):
        top = f"{root}/{variable}/commit={c}"
        paths += [top] if len(held) == now.sizes[f"{variable}/{c}"] else [f"{top}/year={y}/widx={w}" for y, w in sorted(held)]
    df = spark.read.option("basePath", f"{root}/{variable}").schema(schema).parquet(*paths).select(*KEYS, variable)
    if check is not None:
        quality.run_checks([check(df)], "raise")
    return df


def open_store(spark: SparkSession, root: str, variables: list[str], version: int | None = None) -> DataFrame:
    """Several variables side by side, all of one version."""
    now = manifest.load(spark, root, version)
    return merge_products([opened(spark, root, v, now) for v in variables], KEYS)


def write_states(of: dict[str, DataFrame], root: str, commit: str) -> None:
    for v, df in of.items():
        df.write.parquet(f"{root}/_states_{v}/commit={commit}")


def read_state(spark: SparkSession, root: str, variable: str, now: Manifest | None = None) -> DataFrame:
    """The sums and counts by cell and season that appends have kept."""
    now = manifest.load(spark, root) if now is None else now
    if variable not in now.states:
        raise FileNotFoundError(f"{root} has no sums of {variable}")
    return spark.read.parquet(f"{root}/_states_{variable}/commit={now.states[variable]}")
