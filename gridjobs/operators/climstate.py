"""Climatologies that grow with the record: sums and counts by cell and season, which are merged in place of being made again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .climatology import CELL, season


def state(cells: DataFrame, variables: list[str], key: str = "widx", span: int = 8) -> DataFrame:
    """Sum (s_<variable>) and number of values (n_<variable>) of each cell and season; nulls and NaN don't count."""
    value = lambda v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double"))
    out = [x for v in variables for x in (F.sum(value(v)).alias(f"s_{v}"), F.count(value(v)).alias(f"n_{v}"))]
    return cells.groupBy(*CELL, season(key, span).cast("int").alias("season_key")).agg(*out)


def merged(states: list[DataFrame], variables: list[str]) -> DataFrame:
    """Several states as one, in any order."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy(*CELL, "season_key").agg(*[F.sum(f"{p}_{v}").alias(f"{p}_{v}") for v in variables for p in ("s", "n")])


def climatology(state_: DataFrame, variables: list[str]) -> DataFrame:
    """clim_<variable> by cell and season, null where no year has a value."""
    return state_.select(*CELL, "season_key", *[F.try_divide(f"s_{v}", f"n_{v}").alias(f"clim_{v}") for v in variables])


def long_term_mean(state_: DataFrame, variables: list[str]) -> DataFrame:
    """ltm_<variable> by cell, over all values of the record; the record itself isn't read."""
    return state_.groupBy(*CELL).agg(*[F.try_divide(F.sum(f"s_{v}"), F.sum(f"n_{v}")).alias(f"ltm_{v}") for v in variables])
