"""Iterative filling of gaps by truncated singular value decomposition of the times x cells matrix.

Times are few (the windows of a year) and cells are many, so a cell's series is one row. Each round needs the times x times
Gram matrix only, which tasks sum up; its leading eigenvectors give the projection that fills the gaps of every cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import log10_clipped
from ..sources.shared import written
from .fill import coalesced_flag, fill_nearest, log_state

#: Rounds after which the cells are written with what was filled.
KEEP = 4


def replay(values: np.ndarray, guess: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """Cells x times with their gaps filled by the first guess (0 where it isn't a finite number), then by each projection in turn."""
    gap = np.isnan(values)
    x = np.where(gap, np.where(np.isfinite(guess), guess, 0.0), values)
    for p in projections:
        x = np.where(gap, x @ p, x)
    return x


def svd_fill(series: DataFrame, keys: list[str], value: str, guess: str, rank: int = 8, rounds: int = 13, apart: str | None = None) -> tuple[DataFrame, list[float]]:
    """series: keys, and arrays of doubles over the same times for the values and for the first guess.

    apart: a key, few of whose values occur (years); each value's cells are a matrix of their own, with times of their own.
    Where the guess is null or infinite, a gap begins at 0 and is null in the result; the other times of that cell are filled. A cell
    without any guess is land: it stays null and has no part. Returns keys with `filled` and the
    mean absolute error on the known values after each round.

    A round's projection is applied when the cells are read next; every KEEP rounds the cells are written as they are then, so that a
    round reads them once and applies few projections, however many rounds there are.
    """
    types = dict(series.dtypes)
    kept = ", ".join(f"{k} {types[k]}" for k in keys) + f", {value} array<double>, {guess} array<double>, _now array<double>"
    arrays = lambda pdf, c: np.array([[np.nan if x is None else x for x in r] for r in pdf[c]], float)
    projections: dict[str, list[np.ndarray]] = {}
    parts = lambda pdf: pdf.groupby(pdf[apart].astype(str)) if apart else [("", pdf)]

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, tuple] = {}
        for pdf in batches:
            for name, part in parts(pdf):
                v, first, now = arrays(part, value), arrays(part, guess), arrays(part, "_now")
                sea = np.isfinite(first).any(1) if len(first) else np.zeros(0, bool)
                v, now = v[sea], now[sea]
                if not len(v):
                    continue
                own, (g, err, n) = projections.get(name, []), sums.get(name, (0.0, 0.0, 0))
                x = replay(v, now, own)
                if own:
                    known = ~np.isnan(v)
                    before = replay(v, now, own[:-1])
                    err, n = err + float(np.abs((before @ own[-1] - v)[known]).sum()), n + int(known.sum())
                sums[name] = g + x.T @ x, err, n
        for name, (g, err, n) in sums.items():
            yield pd.DataFrame({"part": name, "i": np.arange(g.size), "g": g.ravel(), "err": [err] + [0.0] * (g.size - 1), "n": [n] + [0] * (g.size - 1)})

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """All projections but the last, by which the next round measures its error."""
        for pdf in batches:
            for name, part in parts(pdf):
                if len(part):
                    x = replay(arrays(part, value), arrays(part, "_now"), projections.get(name, [])[:-1])
                    yield part.assign(_now=x.tolist())

    columns, errors = written(series.select(*keys, value, guess, F.col(guess).alias("_now")), "svd-cells"), []
    for done in range(rounds + 1):
        got = columns.mapInPandas(gram, "part string, i int, g double, err double, n long").groupBy("part", "i").agg(F.sum("g").alias("g"), F.sum("err").alias("err"), F.sum("n").alias("n")).toPandas().sort_values(["part", "i"])
        if not len(got):
            break
        if done:
            errors.append(float(got["err"].sum() / max(1, got["n"].sum())))
        if done == rounds:
            break
        if done and done % KEEP == 0:
            columns = written(columns.mapInPandas(advance, kept), "svd-cells")
            projections = {name: own[-1:] for name, own in projections.items()}
        for name, own in got.groupby("part"):
            t = int(round(len(own) ** 0.5))
            _, vectors = np.linalg.eigh(own["g"].to_numpy().reshape(t, t))
            top = vectors[:, ::-1][:, :rank]
            projections.setdefault(name, []).append(top @ top.T)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, part in parts(pdf):
                if len(part):
                    v, first = arrays(part, value), arrays(part, guess)
                    x = replay(v, arrays(part, "_now"), projections.get(name, []))
                    x[(np.isnan(v) & ~np.isfinite(first)) | ~np.isfinite(first).any(1, keepdims=True)] = np.nan
                    yield part[keys].assign(filled=[[None if np.isnan(y) else float(y) for y in r] for r in x])

    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", filled array<double>"
    return columns.mapInPandas(fill, schema), errors


def chlorophyll(cells: DataFrame, original: str = "chl", nearest: str = "near", reconstructed: str = "filled") -> DataFrame:
    """The original value, else the nearest, else the reconstructed one, and which it was."""
    a, b, c = (F.col(x) for x in (original, nearest, reconstructed))
    return cells.withColumns({"chl_filled": F.coalesce(a, b, c), "chl_flag": coalesced_flag(a, b, c)})


def filled_by_year(cells: DataFrame, guess: DataFrame, v: str, g: str, rank: int = 8, rounds: int = 13) -> DataFrame:
    """cells: year, widx, ilat, ilon, v, dense; guess: ilat, ilon, widx, g. The original value, else the nearest along time, latitude and
    longitude, else the low-rank fill of that year's matrix: CELL, chl_filled, chl_flag. A cell of which there is no guess has no row."""
    axes = [(["ilat", "ilon"], ["year", "widx"]), (["year", "widx", "ilon"], ["ilat"]), (["year", "widx", "ilat"], ["ilon"])]
    near = fill_nearest(cells.withColumn("near", F.col(v)), "near", axes).join(guess.select("ilat", "ilon", "widx", F.col(g).alias("_guess")), ["ilat", "ilon", "widx"])
    series = near.groupBy("year", "ilat", "ilon").agg(F.array_sort(F.collect_list(F.struct("widx", "near", "_guess"))).alias("s"))  # the windows of a year
    series = series.select("year", "ilat", "ilon", F.col("s.widx").alias("widx"), F.col("s.near").alias("near"), F.col("s._guess").alias("guess"))
    filled, _ = svd_fill(series, ["year", "ilat", "ilon", "widx"], "near", "guess", rank, rounds, apart="year")
    filled = filled.select("year", "ilat", "ilon", F.explode(F.arrays_zip("widx", "filled")).alias("z")).select("year", "ilat", "ilon", "z.widx", "z.filled")
    got = chlorophyll(near.join(filled, ["year", "widx", "ilat", "ilon"], "left"), v)
    return got.select("year", "widx", "ilat", "ilon", "chl_filled", "chl_flag")


def same_shape(cells: DataFrame, guess: DataFrame) -> None:
    """Every year has the climatology's windows and cells, each once; a year that hasn't is an error, and so is a repeated key of the climatology."""
    keys = ["ilat", "ilon", "widx"]
    size, distinct = guess.agg(F.count("*"), F.count_distinct(*keys)).first()
    if size != distinct:
        raise ValueError("the climatology has a key twice")
    years = cells.join(guess.select(*keys, F.lit(1).alias("_there")), keys, "left").groupBy("year").agg(F.count("*").alias("rows"), F.count("_there").alias("there"), F.count_distinct(*keys).alias("keys"))
    wrong = years.filter((F.col("rows") != size) | (F.col("there") != size) | (F.col("keys") != size)).orderBy("year").limit(5).collect()
    if wrong:
        raise ValueError(f"the climatology has {size} windows and cells; " + "; ".join(f"year {r.year} has {r['rows']}, of which {r.there} are in it" for r in wrong))


def fill_chlorophyll(cells: DataFrame, guess: DataFrame, v: str = "chl", g: str = "clim_chl", convert: bool = False, rank: int = 8, rounds: int = 13) -> DataFrame:
    """Chlorophyll filled year by year, in log10: original (flag 1), nearest (2), reconstructed from the climatology as first guess (3), none (0).

    The climatology is in log10. So are the cells, or with convert they are brought to it, from 0.005 up; negative values that aren't
    log10 are an error, and so is a field without any value, of which neither can be told. Shapes must match (see same_shape).
    """
    if not log_state(guess, g):
        raise ValueError("the climatology isn't in log10")
    if not log_state(cells, v):
        if not convert:
            raise ValueError("the cells aren't in log10")
        cells = cells.withColumn(v, log10_clipped(F.col(v)))
    same_shape(cells, guess)
    return filled_by_year(cells, guess, v, g, rank, rounds)
