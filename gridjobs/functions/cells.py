"""Grid cells by integer index, longitudes, and the formulas of single rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count(extent: float, res: float) -> int:
    n = round(extent / res)
    if n < 1 or abs(n * res - extent) > 1e-6:
        raise ValueError(f"{res} doesn't divide {extent}")
    return n


def lat_index(lat: Column, res: float) -> Column:
    """Row of the cell that holds a latitude; the upper edge belongs to the last row."""
    return F.least(F.floor((lat + 90) / res), F.lit(count(180, res) - 1)).cast("int")


def lon_index(lon: Column, res: float) -> Column:
    """Column of the cell that holds a longitude, given in either convention."""
    return F.least(F.floor((wrapped(lon) + 180) / res), F.lit(count(360, res) - 1)).cast("int")


def lat_center(ilat: Column, res: float) -> Column:
    return (ilat + 0.5) * res - 90


def lon_center(ilon: Column, res: float) -> Column:
    return (ilon + 0.5) * res - 180


def wrapped(lon: Column) -> Column:
    """Longitude from -180 (included) to 180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def missing_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN means no data: averages must not see it."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def renamed(df: DataFrame, names: dict[str, str], keys: list[str]) -> DataFrame:
    """Keys and the mapped variables under their new names; no mapping keeps all."""
    return df.select(*keys, *[F.col(a).alias(b) for a, b in names.items()]) if names else df


def like(df: DataFrame, pattern: str = r"sigma|flag|uncert") -> list[str]:
    """Columns whose name holds the pattern: uncertainties and flags, which get no spread of their own."""
    return [c for c in df.columns if re.search(pattern, c)]


def wind_moments(u: Column, v: Column) -> dict[str, Column]:
    """Second and third moments: sums of the components' squares and cubes."""
    return {"wind_moment2": u * u + v * v, "wind_moment3": u * u * u + v * v * v}


def log10_clipped(x: Column, least: float = 5e-3) -> Column:
    return F.when(x.isNotNull(), F.log10(F.greatest(x, F.lit(least))))


def water_vapour_pressure(celsius: Column, salinity: Column) -> Column:
    """In atm over sea water: Dickson et al. 2007, after Wagner and Pruss (pure water) and Millero (osmotic coefficient)."""
    k = celsius + 273.15
    x = 1 - k / 647.096
    # The coefficients and exponents of the saturation curve, and those of the osmotic coefficient.
    terms = ((-7.85951783, 1.0), (1.84408259, 1.5), (-11.7866497, 3.0), (22.6807411, 3.5), (-15.9618719, 4.0), (1.80122502, 7.5))
    fresh = F.exp(647.096 / k * sum((F.pow(x, F.lit(p)) * a for a, p in terms), F.lit(0.0))) * (22.064 / 101325e-6)
    molality = 31.998 * salinity / (1e3 - 1.005 * salinity)
    half = 0.5 * molality
    osmotic = 0.90799 - 0.08992 * half + 0.18458 * half * half - 0.07395 * F.pow(half, F.lit(3)) - 0.00221 * F.pow(half, F.lit(4))
    return fresh * F.exp(-0.018 * osmotic * molality)


def fugacity(xco2_ppm: Column, celsius: Column, pascal: Column, salinity: Column) -> Column:
    """fCO2 in uatm from dry-air xCO2: water vapour off the pressure, then the virial expansion of Weiss 1974."""
    atm = pascal / 101325.0
    k = celsius + 273.15
    partial = xco2_ppm * (atm - water_vapour_pressure(celsius, salinity))
    b = -1636.75 + 12.0408 * k - 0.0327957 * k * k + 3.16528e-5 * F.pow(k, F.lit(3))
    delta = 57.7 - 0.118 * k
    dry = F.pow(1 - xco2_ppm * 1e-6, F.lit(2))
    return partial * F.exp((b + 2 * dry * delta) * atm / (82.05736 * k))


def level(df: DataFrame, keys: list[str], depth: str, variables: list[str], nth: int | None = None) -> DataFrame:
    """One depth for each key: the nth from the top, or the one nearest to the surface (of two as near, the smaller)."""
    if nth is None:
        order = F.struct(F.abs(depth), F.col(depth))
        return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in variables])
    depths = df.select(F.col(depth).alias("_d")).distinct()
    wanted = depths.orderBy("_d").offset(nth).limit(1)  # depths are few
    return df.join(F.broadcast(wanted), F.col(depth) == F.col("_d"), "left_semi").select(*keys, *variables)


def first_by_coordinates(df: DataFrame, time: str, order: str, digits: int = 3) -> DataFrame:
    """Coordinates rounded, and of rows at the same time and place the first in the given order."""
    from pyspark.sql import Window

    df = df.withColumns({"lat": F.round("lat", digits), "lon": F.round("lon", digits)})
    first = F.row_number().over(Window.partitionBy(time, "lat", "lon").orderBy(order))
    return df.withColumn("_first", first).filter("_first = 1").drop("_first")


def squeezed(df: DataFrame, keys: list[str], keep: tuple[str, ...] = ("time", "lat", "lon", "ilat", "ilon")) -> DataFrame:
    """Without the key columns that hold a single value, but for time and place."""
    loose = [k for k in keys if k not in keep]
    n = df.agg(*[F.count_distinct(k).alias(k) for k in loose]).first() if loose else {}
    return df.drop(*[k for k in loose if n[k] <= 1])
