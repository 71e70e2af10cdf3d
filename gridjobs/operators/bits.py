"""Sets of grid keys as bits: 64 neighbouring positions of an axis in a row, so that a set is small enough to go to the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(keys: DataFrame, part: list[str], at: str) -> DataFrame:
    """part, _word, _bits: which positions `at` (integers) each part has. Keys that are null aren't in the set; repeats count once."""
    known = keys.dropna(subset=[*part, at])
    return known.groupBy(*part, F.expr(f"shiftright(CAST({at} AS BIGINT), 6)").alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod({at}, 64) AS INT))")).alias("_bits"))


def within(df: DataFrame, bits: DataFrame, part: list[str], at: str) -> DataFrame:
    """The rows whose key is in the set, exactly. The set, which the caller bounds, is broadcast: the rows don't travel."""
    keyed = df.withColumn("_word", F.expr(f"shiftright(CAST({at} AS BIGINT), 6)")).join(F.broadcast(bits), [*part, "_word"])
    return keyed.filter(F.expr(f"getbit(_bits, CAST(pmod({at}, 64) AS INT)) = 1")).select(*df.columns)
