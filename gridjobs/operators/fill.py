"""Filling gaps: from other sources with flags, from neighbours, by low-rank reconstruction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import prefix


def fill_with_flag(df: DataFrame, a: str, b: str, out: str, flag: str) -> DataFrame:
    """a where it has a value, else b. flag: 1 from a, 2 from b, 0 neither."""
    return fill_successively(df, [a, b], out, flag)


def fill_successively(df: DataFrame, sources: list[str], out: str, flag: str) -> DataFrame:
    """The first source that has a value, and its number from 1; 0 where none has."""
    if len(sources) < 2:
        raise ValueError("at least two sources")
    which = reduce(lambda w, i: w.when(F.col(sources[i]).isNotNull(), i + 1), range(1, len(sources)), F.when(F.col(sources[0]).isNotNull(), 1))
    return df.withColumns({out: F.coalesce(*sources), flag: which.otherwise(0).cast("int")})


def merge_products(products: list[DataFrame], keys: list[str]) -> DataFrame:
    """Products side by side by cell, a cell of any product kept: one union and one group-by in place of full outer joins.

    A key that a product has twice is an error, found in the same group-by.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("_p", F.lit(i)) for i, p in enumerate(products)])
    most = [F.count_if(F.col("_p") == i) for i in range(len(products))]
    most = F.greatest(*most) if len(most) > 1 else most[0]
    got = both.groupBy(*keys).agg(*[F.first(c, True).alias(c) for c in both.columns if c not in (*keys, "_p")], most.alias("_most"))
    said = F.concat_ws(" ", F.lit("a product has a key twice:"), *[F.col(k).cast("string") for k in keys])
    return got.filter(F.when(F.col("_most") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))).drop("_most")


def fill_nearest(cells: DataFrame, v: str, axes: list[tuple[list[str], list[str]]]) -> DataFrame:
    """One step forward, then one back, along each axis in turn: (partition columns, order columns) of each. Rows must be dense."""
    for part, order in axes:
        w = Window.partitionBy(*part).orderBy(*order)
        for step in (F.lag, F.lead):
            cells = cells.withColumn(v, F.coalesce(F.col(v), step(v).over(w)))
    return cells


def dense(cells: DataFrame, time_keys: list[str], cell_keys: list[str]) -> DataFrame:
    """A row for every time and cell that occur: a lag over rows is then a lag in time."""
    times, places = cells.select(*time_keys).distinct(), cells.select(*cell_keys).distinct()
    times = times.agg(F.array_sort(F.collect_set(F.struct(*time_keys))).alias("_t"))  # a calendar: some thousand windows at most
    spine = places.join(F.broadcast(times), F.lit(True)).select(*cell_keys, F.explode("_t").alias("_t")).select(*[F.col(f"_t.{k}").alias(k) for k in time_keys], *cell_keys)
    return spine.join(cells, [*time_keys, *cell_keys], "left")


def interpolate_positions(series: DataFrame, v: str, order: str, part: list[str] | None = None) -> DataFrame:
    """Interior nulls linearly by row position; trailing ones take the last value, leading ones stay."""
    from .regrid import between, neighbours_along

    if not part:  # one series, however long
        rows = prefix.known_around(prefix.numbered(series, [order], "_n"), v, ["_n"], carry=["_n"])
        a, b, t, u = F.col(f"before.{v}"), F.col(f"after.{v}"), F.col("before._n"), F.col("after._n")
        return rows.withColumn(v, F.coalesce(v, F.when(u > t, a + (b - a) * (F.col("_n") - t) / (u - t)), a)).drop("_n", "before", "after")
    n = F.row_number().over(Window.partitionBy(*part).orderBy(order))
    s = series.withColumn("_n", n)
    last = neighbours_along(F.col(v), F.col("_n"), part)[0]
    return s.withColumn(v, F.coalesce(between(F.col(v), F.col("_n"), part), last)).drop("_n")


def log_state(df: DataFrame, v: str) -> bool:
    """Whether a field is in log10 already: it goes below -0.1 and stays under 10. Negatives elsewhere are an error."""
    low, high = df.agg(F.min(v), F.max(v)).first()
    if low is None:
        return False
    if low < -0.1 and high < 10:
        return True
    if low < 0:
        raise ValueError("negative values in a field that isn't in log10")
    return False


def coalesced_flag(first: Column, second: Column, third: Column) -> Column:
    """1 original, 2 nearest, 3 reconstructed, 0 none."""
    return F.when(first.isNotNull(), 1).when(second.isNotNull(), 2).when(third.isNotNull(), 3).otherwise(0).cast("int")
