"""Windows of a fixed number of days that restart each January 1, as closed-form columns.

The last window of a year ends at the next January 1, so it is shorter. Spans are whole days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = 8


def checked(span: int) -> int:
    if int(span) != span or not 1 <= span <= 366:
        raise ValueError(f"a window spans 1 to 366 whole days, not {span}")
    return int(span)


def per_year(span: int = SPAN) -> int:
    return -(-365 // checked(span)) if 365 % span else 365 // span


def index(t: Column, span: int = SPAN) -> Column:
    """Zero-based window of a time within its year."""
    return F.floor((F.dayofyear(t) - 1) / checked(span)).cast("int")


def index_of_day(doy: Column, span: int = SPAN) -> Column:
    """Window of a day of the year; a day outside 1 to 366 is an error."""
    ok = doy.between(1, 366)
    return F.when(ok, F.floor((doy - 1) / checked(span)).cast("int")).otherwise(F.raise_error(F.concat(F.lit("day of year out of range: "), doy.cast("string"))).cast("int"))


def start(year: Column, widx: Column, span: int = SPAN) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (widx * span).cast("int"))


def end(year: Column, widx: Column, span: int = SPAN) -> Column:
    """First day after the window."""
    return F.least(F.date_add(start(year, widx, span), span), F.make_date(year + 1, F.lit(1), F.lit(1)))


def hours_after(day: Column, hours: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))


def center(year: Column, widx: Column, span: int = SPAN) -> Column:
    a = start(year, widx, span)
    return hours_after(a, F.datediff(end(year, widx, span), a) * 12)


def last_second(year: Column, widx: Column, span: int = SPAN) -> Column:
    """Right edge of the window, less a second."""
    return end(year, widx, span).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(1))


def decimal_year_date(x: Column) -> Column:
    """Date of a decimal year: day floor(fraction * 365 + 1)."""
    return F.date_add(F.make_date(F.floor(x).cast("int"), F.lit(1), F.lit(1)), F.floor((x - F.floor(x)) * 365).cast("int"))


def windows(spark: SparkSession, first_year: int, last_year: int, span: int = SPAN, as_of: str | None = None) -> DataFrame:
    """Calendar: year, widx, window_start, window_end, window_center; windows that aren't over at as_of are left out."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    y, w = F.col("year"), F.col("widx")
    out = years.withColumn("widx", F.explode(F.sequence(F.lit(0), F.floor((F.dayofyear(F.make_date(y, F.lit(12), F.lit(31))) - 1) / checked(span)).cast("int"))))
    out = out.select(y, w, start(y, w, span).cast("timestamp_ntz").alias("window_start"), end(y, w, span).cast("timestamp_ntz").alias("window_end"), center(y, w, span).alias("window_center"))
    return out.filter(F.col("window_end") <= F.lit(as_of).cast("timestamp_ntz")) if as_of else out


def with_window(df: DataFrame, time: str, span: int = SPAN) -> DataFrame:
    return df.withColumns({"year": F.year(time).cast("int"), "widx": index(F.col(time), span)})


def adjacent(df: DataFrame, span: int = SPAN) -> DataFrame:
    """Adds the previous and the next window of (year, widx), across years; an index that the year lacks is an error."""
    y, w = F.col("year"), F.col("widx")
    last = per_year(span) - 1
    ok = F.when(w.between(0, last), w).otherwise(F.raise_error(F.lit("no such window")).cast("int"))
    first, final = w == 0, w == last
    return df.withColumn("widx", ok).withColumns(
        {"prev_year": y - first.cast("int"), "prev_widx": F.when(first, last).otherwise(w - 1), "next_year": y + final.cast("int"), "next_widx": F.when(final, 0).otherwise(w + 1)}
    )


def days(df: DataFrame, span: int = SPAN) -> DataFrame:
    """A row for each day of each window, at noon."""
    y, w = F.col("year"), F.col("widx")
    return df.withColumn("d", F.explode(F.sequence(start(y, w, span), F.date_sub(end(y, w, span), 1)))).withColumn("day", hours_after(F.col("d"), F.lit(12))).drop("d")


def most_recent(as_of: Column, buffer_days: int = SPAN, span: int = SPAN) -> Column:
    """(year, widx) of the last window that is over buffer_days before as_of."""
    t = F.date_sub(as_of.cast("date"), buffer_days)
    y, w = F.year(t), index(t, span)
    over = end(y, w, span) <= t
    return F.when(over, F.struct(y.alias("year"), w.alias("widx"))).when(w > 0, F.struct(y.alias("year"), (w - 1).alias("widx"))).otherwise(F.struct((y - 1).alias("year"), F.lit(per_year(span) - 1).alias("widx")))


def bounds_status(df: DataFrame, time_start: str | None, time_end: str, span: int = SPAN) -> DataFrame:
    """Adds in_bounds and a reason: does the whole window lie within the product's time range? An open start is 1970."""
    y, w = F.col("year"), F.col("widx")
    early = start(y, w, span) < F.lit(time_start or "1970-01-01").cast("date")
    late = end(y, w, span) > F.lit(time_end).cast("date")
    reason = F.when(early, "before the start").when(late, "after the end").otherwise("within")
    return df.withColumns({"in_bounds": ~(early | late), "reason": reason})


def extended(df: DataFrame, span: int = SPAN) -> DataFrame:
    """Adds the edges of a window with the wings that interpolation in time needs: span/2 + 1 days before, span/2 after."""
    y, w, half = F.col("year"), F.col("widx"), span // 2
    return df.withColumns({"wing_start": F.date_sub(start(y, w, span), half + 1).cast("timestamp_ntz"), "wing_end": F.date_add(end(y, w, span), half).cast("timestamp_ntz")})


def steps_per_window(df: DataFrame, time: str = "time", span: int = SPAN) -> DataFrame:
    """One row: steps, whole time steps of the median spacing in a window; 1 for a single time, an error for none."""
    t = df.select(F.unix_timestamp(F.col(time).cast("timestamp")).alias("t")).filter("t IS NOT NULL").distinct()
    from ..operators.prefix import rolling

    gaps = rolling(t, ["t"], lambda rows, frame: rows.withColumn("gap", F.col("t") - F.first("t").over(frame(-1, -1))), 1)
    one = gaps.agg(F.count("t").alias("n"), F.median("gap").alias("gap"))
    none = F.raise_error(F.lit("no time steps")).cast("long")
    return one.select(F.when(F.col("n") == 0, none).when(F.col("n") == 1, F.lit(1)).otherwise(F.floor(span * 86400 / F.col("gap"))).cast("long").alias("steps"))
