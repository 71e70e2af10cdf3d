"""Readers: product entries, dated paths, station and surface text files, observations, split tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import decimal_year_date
from ..operators.fill import interpolate_positions


@dataclass(frozen=True)
class Entry:
    """One run of a product: where its cells are, the times that are used, the variables' names, and the run's flag."""

    path: str
    names: dict[str, str] = field(default_factory=dict)
    time_start: str | None = None
    time_end: str | None = None
    flag: int | None = None


def clip(df: DataFrame, time: str, first: str | None, last: str | None) -> DataFrame:
    """Rows of a time range, both ends included; None leaves an end open. A plain comparison, so that Parquet skips row groups."""
    if first is not None:
        df = df.filter(F.col(time) >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        df = df.filter(F.col(time) <= F.lit(last).cast("timestamp_ntz"))
    return df


def concat(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def prepare(df: DataFrame, entry: Entry, product: str, keys: list[str], time: str = "time", nrt_from: str | None = None) -> DataFrame:
    """An entry's rows: clipped, its variables renamed and the rest dropped, flagged by its number and, if asked, as near-real-time."""
    df = clip(df, time, entry.time_start, entry.time_end)
    if entry.names:
        df = df.select(*keys, *[F.col(a).alias(b) for a, b in entry.names.items()])
    if entry.flag is not None:
        df = df.withColumn(f"flag_{product}", F.lit(entry.flag))
    if nrt_from is not None:
        df = df.withColumn("is_nrt", F.col(time) >= F.lit(nrt_from).cast("timestamp_ntz"))
    return df


def open_product(spark: SparkSession, entries: list[Entry], product: str, keys: list[str], time: str = "time", nrt_from: str | None = None) -> DataFrame:
    return concat(prepare(spark.read.parquet(e.path), e, product, keys, time, nrt_from) for e in entries)


def versioned(dates: DataFrame, versions: DataFrame, template: str, date: str = "date") -> DataFrame:
    """Adds the path of each date: template with %1$s the date as yyyyMMdd and %2$s the name of the version that holds then.

    versions: name, time_start, time_end (null: open); a handful of rows, broadcast.
    """
    ok = (F.col("time_start").isNull() | (F.col(date) >= F.col("time_start"))) & (F.col("time_end").isNull() | (F.col(date) <= F.col("time_end")))
    got = dates.join(F.broadcast(versions), ok, "left")
    return got.withColumn("path", F.format_string(template, F.date_format(date, "yyyyMMdd"), F.col("name")))


def read_dated(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Those of the paths that exist, as one table; none is an error. Existence is asked of the store that Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = [p for p in paths if (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(h)]
    if not there:
        raise FileNotFoundError(f"none of {len(paths)} paths exists, the first is {paths[:1]}")
    return spark.read.parquet(*there)


def station_series(spark: SparkSession, path: str, value: str = "increase_since_1800") -> DataFrame:
    """Weekly station CSV: comment lines start with #, -999.99 is null, blanks in names become _. Returns d, x; null inside filled linearly."""
    df = spark.read.csv(path, header=True, comment="#", nullValue="-999.99", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    df = df.toDF(*[c.strip().replace(" ", "_") for c in df.columns])
    number = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")
    d = F.make_date(*[number(c).cast("int") for c in ("year", "month", "day")])
    x = F.when(number(value) != -999.99, number(value))
    return interpolate_positions(df.select(d.alias("d"), x.alias("x")), "x", "d")


def surface_table(spark: SparkSession, path: str) -> DataFrame:
    """Latitude surface: a header with MBL ... SURFACE, # lines, then a decimal year and (value, uncertainty) for 41 sine latitudes.

    Returns d, k (0 to 40), lat, value.
    """
    text = spark.read.text(path).withColumn("value", F.trim("value"))
    if text.filter(F.col("value").startswith("#") & F.col("value").rlike("MBL.*SURFACE")).limit(1).count() == 0:
        raise ValueError(f"{path} isn't a surface table")
    parts = text.filter((F.col("value") != "") & ~F.col("value").startswith("#")).select(F.transform(F.split("value", r"\s+"), lambda x: x.cast("double")).alias("a"))
    rows = parts.select(decimal_year_date(F.col("a")[0]).alias("d"), F.posexplode(F.slice("a", 2, 1_000)).alias("i", "value")).filter("i % 2 = 0")
    k = F.floor(F.col("i") / 2)
    return rows.select("d", k.cast("int").alias("k"), F.degrees(F.asin(-1 + 2 * k / 40)).alias("lat"), "value")


def observations_to_parquet(spark: SparkSession, tsv: str, parquet: str, schema: str) -> DataFrame:
    """Tab-separated ship observations with a header, of a given schema, as Parquet."""
    spark.read.csv(tsv, sep="\t", header=True, schema=schema).write.mode("overwrite").parquet(parquet)
    return spark.read.parquet(parquet)


def split_table(spark: SparkSession, folder: str, split: str, subset: str, columns: list[str]) -> DataFrame:
    """Numbers of a train, val or test table, as floats; a path that isn't there is an error."""
    df = spark.read.csv(f"{folder}/{split}/{subset}.csv", header=True, schema=", ".join(f"`{c}` double" for c in columns))
    return df.select(*[F.col(c).cast("float").alias(c) for c in columns])
