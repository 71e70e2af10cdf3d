"""Point observations on the grid, their categories, and their colocation with features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import SPAN, with_window
from ..functions.cells import lat_index, lon_index
from ..sources.shared import written

CELL = ["year", "widx", "ilat", "ilon"]
#: Values that a task looks for copies among, about; groups that the rows of a crowded cell are dealt to.
DEALT, PARTS = 1_000_000, 64


def with_cells(obs: DataFrame, res: float, time: str = "obs_time", span: int = SPAN) -> DataFrame:
    """Window and cell of each observation by arithmetic: no join."""
    return with_window(obs, time, span).withColumns({"ilat": lat_index(F.col("lat"), res), "ilon": lon_index(F.col("lon"), res)})


def grid(obs: DataFrame, measures: list[str], res: float, time: str = "obs_time", span: int = SPAN, ddof: int = 0) -> DataFrame:
    """Mean, spread and number of each measure by window and cell; partial sums make a crowded cell no heavier than others."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    out = [f(m).alias(f"{m}_{n}") for m in measures for f, n in ((F.avg, "mean"), (spread, "std"))]
    return with_cells(obs, res, time, span).groupBy(*CELL).agg(*out, F.count("*").alias("n"))


def with_codes(df: DataFrame, columns: list[str], suffix: str = "_idx") -> DataFrame:
    """Integer codes of categories, by their order from 0; null stays null.

    The distinct categories are dealt to ranges and written, numbered inside each range, and moved on by the number of those in earlier
    ranges, a row for each range: no task sees all categories.
    """
    for c in columns:
        names = df.select(F.col(c).alias("name")).filter("name IS NOT NULL").distinct()
        names = written(names.repartitionByRange("name").withColumn("range", F.spark_partition_id()), "categories")
        before = names.groupBy("range").count().select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("before"))
        at = F.row_number().over(Window.partitionBy("range").orderBy("name")) - 1
        codes = names.withColumn("at", at).join(F.broadcast(before), "range").select(F.col("name").alias(c), (F.col("at") + F.col("before")).cast("int").alias(c + suffix))
        df = df.join(codes, c, "left")
    return df


def different(df: DataFrame, keys: list[str], of: dict[str, str], rows: int) -> DataFrame:
    """The number of different values of several columns by key, nulls left out: name -> column. Keys with nulls alone have no row.

    rows: of df, about. Values travel without what else is summed up by key. They are first dealt so that a task drops the copies among
    about DEALT of them, and then by key and value; one key, however many rows it has, is dealt to PARTS groups at first.
    """
    dealt = df.select(*keys, *of.values()).withColumn("_part", F.monotonically_increasing_id() % PARTS)
    dealt = dealt.repartition(rows * len(of) // DEALT + 1, *keys, "_part")
    stacked = F.array(*[F.struct(F.lit(i).alias("_of"), F.col(c).alias("_value")) for i, c in enumerate(of.values())])
    values = dealt.select(*keys, F.explode(stacked).alias("_x")).select(*keys, "_x._of", "_x._value").filter("_value IS NOT NULL").distinct()
    return values.groupBy(*keys).agg(*[F.count_if(F.col("_of") == i).alias(name) for i, name in enumerate(of)])


def colocate(observed: DataFrame, features: DataFrame, how: str = "inner") -> DataFrame:
    """Gridded observations with the features of their window and cell."""
    return observed.join(features, CELL, how)
