"""One pass for many checks: each check, by name, says which facts of a window it needs; the facts of all are aggregated together,
and every report is made from that small table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import SPAN, per_year, windows
from ..functions.cells import count
from ..sources.shared import written
from . import quality

KEY = ["year", "widx"]
#: Longitudes whose presence one long holds, a bit each.
BITS = 64


class Fact(NamedTuple):
    """A number of each window: the aggregate of its rows, and the aggregate that joins the numbers of its parts (`sum`, `max` or `bit_or`).

    A fact of bits is joined over latitudes by bit_or or counted and summed, as `count_bits` says, before the longitudes meet.
    """

    rows: Column
    join: str
    count_bits: bool = False


class Check(NamedTuple):
    """facts by name, and either a report row of each window (subject, ok, detail) or a report made from the table of windows."""

    facts: dict[str, Fact]
    row: tuple[Column, Column, Column] | None = None
    table: Callable[[DataFrame], DataFrame] | None = None


def bit() -> Column:
    """The bit of a row's longitude in its word."""
    return F.expr(f"shiftleft(1L, CAST(pmod(ilon, {BITS}) AS INT))")


def grid(res: float) -> Check:
    """Every cell of the target grid, and no other."""
    nlat, nlon = count(180, res), count(360, res)
    inside = F.coalesce(F.col("ilat").between(0, nlat - 1) & F.col("ilon").between(0, nlon - 1), F.lit(False))
    facts = {
        "cells_inside": Fact(F.bit_or(F.when(inside, bit())), "sum", True),
        "cells_foreign": Fact(F.bit_or(F.when(~inside, bit())), "sum", True),
        "rows_without_longitude": Fact(F.max(F.col("ilon").isNull().cast("long")), "sum"),
    }
    missing = F.lit(nlat * nlon) - F.coalesce("cells_inside", F.lit(0))
    foreign = F.coalesce("cells_foreign", F.lit(0)) + F.col("rows_without_longitude")
    return Check(facts, (quality.window_name(), (missing == 0) & (foreign == 0), F.concat_ws(",", missing, foreign)))


def shape(nlat: int, nlon: int) -> Check:
    """So many latitudes and longitudes, and a cell for every pair of them."""
    words = -(-nlat // BITS)
    lats = {f"lats_{k}": Fact(F.bit_or(F.expr(f"CASE WHEN ilat BETWEEN {k * BITS} AND {k * BITS + BITS - 1} THEN shiftleft(1L, CAST(pmod(ilat, {BITS}) AS INT)) END")), "bit_or") for k in range(words)}
    outside = Fact(F.max(F.expr(f"CAST(ilat NOT BETWEEN 0 AND {words * BITS - 1} AS BIGINT)")), "max")
    facts = lats | {"lons": Fact(F.bit_or(bit()), "bit_or"), "cells": Fact(F.bit_or(bit()), "sum", True), "outside": outside}
    a = reduce(lambda x, y: x + y, [F.coalesce(n, F.lit(0)) for n in lats])
    o = F.coalesce("lons", F.lit(0))
    return Check(facts, (quality.window_name(), (a == nlat) & (o == nlon) & (F.col("cells") == nlat * nlon) & (F.col("outside") == 0), F.concat_ws("x", a, o)))


def longitudes(v: str, nlon: int) -> Check:
    """Every longitude has a value of v."""
    n = F.coalesce(f"lons_{v}", F.lit(0))
    return Check({f"lons_{v}": Fact(F.bit_or(F.when(F.col(v).isNotNull(), bit())), "bit_or")}, (quality.window_name(), n == nlon, F.lit(nlon) - n))


def data(v: str, span: int = SPAN) -> Check:
    """Every window of the years that occur has a value of v; a window without any row has none."""

    def table(facts: DataFrame) -> DataFrame:
        first, last = facts.agg(F.min("year"), F.max("year")).first()
        if first is None:
            return quality.report(facts, "data", F.lit(""), F.lit(True), F.lit(""))
        all_ = windows(facts.sparkSession, first, last, span).select(*KEY).join(facts.select("year").distinct(), "year", "left_semi")
        got = all_.join(facts.select(*KEY, F.col(f"values_{v}").alias("n")), KEY, "left")
        return quality.report(got, "data", quality.window_name(), F.col("n") > 0, F.coalesce("n", F.lit(0)))

    return Check({f"values_{v}": Fact(F.count(v), "sum")}, table=table)


def land(v: str, res: float, points: tuple = quality.LAND, expect_null: bool = True) -> Check:
    """Points on land have no value of v (or have one): a row for each window and point that has a cell."""
    nlat, nlon = count(180, res), count(360, res)
    cells = sorted({(min(int((a + 90) // res), nlat - 1), int(((o + 180) % 360) // res) % nlon) for a, o in points})
    at = lambda a, o: (F.col("ilat") == a) & (F.col("ilon") == o)
    facts = {f"land_{v}_{a}_{o}": Fact(F.max(F.when(at(a, o), F.col(v).isNotNull().cast("long"))), "max") for a, o in cells}

    def table(got: DataFrame) -> DataFrame:
        each = F.array(*[F.struct(F.lit(a).alias("ilat"), F.lit(o).alias("ilon"), F.col(f"land_{v}_{a}_{o}").alias("valued")) for a, o in cells])
        rows = got.select(*KEY, F.inline(each)).filter("valued IS NOT NULL")
        return quality.report(rows, "land", F.concat_ws("/", quality.window_name(), "ilat", "ilon"), F.col("valued") == (0 if expect_null else 1), F.col("valued"))

    return Check(facts, table=table)


def full_year(span: int = SPAN) -> Check:
    def table(facts: DataFrame) -> DataFrame:
        n = facts.groupBy("year").agg(F.count("widx").alias("n"))
        return quality.report(n, "full year", F.col("year"), F.col("n") == per_year(span), F.col("n"))

    return Check({}, table=table)


def single_year() -> Check:
    return Check({}, table=lambda facts: quality.single_year(facts))


def facts_of(cells: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """The facts of each window that all checks need, from one scan.

    Rows are first summed up by window, latitude and word of 64 longitudes, partly before the shuffle, so that at most a 64th of a
    grid's cells travel; then by window and word, then by window. Repeated rows set the same bit once: no distinct is needed.
    """
    need: dict[str, Fact] = {}
    for name, check in checks.items():
        for fact, how in check.facts.items():
            if fact in need and str(need[fact].rows) != str(how.rows):
                raise ValueError(f"{name}: {fact} has two meanings")
            need[fact] = how
    word = F.expr(f"ilon DIV {BITS} - CASE WHEN ilon < 0 AND ilon % {BITS} <> 0 THEN 1 ELSE 0 END").alias("word")
    by_row = cells.groupBy(*KEY, "ilat", word).agg(F.count("*").alias("rows"), *[f.rows.alias(n) for n, f in need.items()])
    bits = lambda n, f: F.bit_count(n).cast("long") if f.count_bits else F.col(n)
    by_word = by_row.groupBy(*KEY, "word").agg(F.sum("rows").alias("rows"), *[F.call_function(f.join, bits(n, f)).alias(n) for n, f in need.items()])
    lat = lambda n: n.startswith("lats_")  # noqa: E731  the same latitudes in every word
    last = {n: F.bit_count(F.bit_or(n)).cast("long") if lat(n) else F.sum(F.bit_count(n).cast("long")) if f.join == "bit_or" else F.call_function(f.join, F.col(n)) for n, f in need.items()}
    return by_word.groupBy(*KEY).agg(F.sum("rows").alias("rows"), *[c.alias(n) for n, c in last.items()])


def run(cells: DataFrame, checks: dict[str, Check], policy: str = "raise") -> DataFrame:
    """All checks' reports (check, subject, ok, detail) from one scan of the cells; policy on failures: raise, warn or ignore.

    The facts, a row for each window, are written once and read by every report. Empty cells give the reports of no windows.
    """
    facts = written(facts_of(cells, checks), "facts")
    reports = [check.table(facts) for check in checks.values() if check.table]
    rows = [(n, c.row) for n, c in checks.items() if c.row]
    if rows:
        each = F.array(*[F.struct(F.lit(n).alias("check"), s.cast("string").alias("subject"), F.coalesce(ok, F.lit(False)).alias("ok"), d.cast("string").alias("detail")) for n, (s, ok, d) in rows])
        reports.append(facts.select(F.inline(each)))
    return quality.run_checks(reports, policy)


#: Checks by the names that a job's settings give; each gets the variable, the cells' size and the window's span.
BY_NAME: dict[str, Callable[[str, float, int], Check]] = {
    "grid": lambda v, res, span: grid(res),
    "shape": lambda v, res, span: shape(count(180, res), count(360, res)),
    "longitudes": lambda v, res, span: longitudes(v, count(360, res)),
    "data": lambda v, res, span: data(v, span),
    "land": lambda v, res, span: land(v, res),
    "full year": lambda v, res, span: full_year(span),
    "single year": lambda v, res, span: single_year(),
}


def named(names: list[str], v: str, res: float, span: int = SPAN) -> dict[str, Check]:
    """The checks of these names; an unknown name is an error."""
    if unknown := [n for n in names if n not in BY_NAME]:
        raise ValueError(f"unknown checks {unknown}, known are {sorted(BY_NAME)}")
    return {n: BY_NAME[n](v, res, span) for n in names}
