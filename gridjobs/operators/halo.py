"""Filling gaps from their neighbours where only the gaps and the cells one step beside them travel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from . import bits

#: Rows of the set of gaps, 64 positions each, that is broadcast at most: some 100 MB.
LIMIT = 1_000_000


def offers(known: DataFrame, v: str, place: list[str], at: str, wanted: DataFrame | None = None) -> DataFrame:
    """What known cells give to the positions before and after them on an axis, only to those of the set `wanted` where it is given."""
    to = F.explode(F.array(*[F.struct((F.col(at) + step).alias("at"), F.lit(rank).alias("rank")) for step, rank in ((1, 0), (-1, 1))]))
    out = known.select(*place, to.alias("_to"), F.col(v).alias("_v")).select(*place, F.col("_to.at").alias(at), F.col("_to.rank").alias("_rank"), "_v")
    return out if wanted is None else bits.within(out, wanted, place, at)


def fill_gaps(cells: DataFrame, v: str, axes: list[tuple[list[str], str]], limit: int = LIMIT) -> DataFrame:
    """Null values take the value one position before, else the one after, along each axis in turn: (keys of a line, its position).

    Positions are integers; a neighbour is at the next integer, whether or not there are rows in between elsewhere. The result is
    that of one step forward and one back over dense rows. A gap whose key holds a null stays; repeated gaps are filled alike; of
    repeated known cells the smallest value is taken. Known rows stay where they are, in any number; the gaps are written after each
    axis. The set of gaps goes to the known cells as bits, if it has at most `limit` rows; otherwise all known values are offered, and
    travel as two narrow rows each.
    """
    known, gaps = cells.filter(F.col(v).isNotNull()), written(cells.filter(F.col(v).isNull()), "gaps")
    for place, at in axes:
        wanted = written(bits.bitmap(gaps, place, at), "gap-bits")
        got = offers(known, v, place, at, wanted if wanted.count() <= limit else None).groupBy(*place, at).agg(F.min(F.struct("_rank", "_v"))["_v"].alias(v))
        now = written(gaps.drop(v).join(got, [*place, at], "left").select(*cells.columns), "gaps")
        known, gaps = known.unionByName(now.filter(F.col(v).isNotNull())), now.filter(F.col(v).isNull())
    return known.unionByName(gaps)
