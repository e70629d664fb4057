"""The canonical grid: 721 rows from +90 to -90 degrees, 1440 columns from -180, a quarter degree apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS, COLUMNS, STEP = 721, 1440, 0.25


def latitude(row: Column) -> Column:
    return F.round(F.lit(90.0) - STEP * row, 6)


def longitude(column: Column) -> Column:
    return F.round(F.lit(-180.0) + STEP * column, 6)


def signed_longitude(lon: Column) -> Column:
    """Into [-180, 180). pmod, as % keeps the dividend's sign."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def angular_distance(a: Column, b: Column) -> Column:
    """Degrees between longitudes, the short way round."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def area_weight(lat: Column) -> Column:
    return F.greatest(F.cos(F.radians(lat)), F.lit(0.0))


def row_of(lat: Column) -> Column:
    return F.rint((90.0 - lat) / STEP).cast("int")


def column_of(lon: Column) -> Column:
    return F.rint((signed_longitude(lon) + 180.0) / STEP).cast("int")


def cell_of(row: Column, column: Column) -> Column:
    return row * COLUMNS + column


def cells(spark: SparkSession) -> DataFrame:
    """Every cell: cell_id, grid_row, grid_col, lat, lon, w."""
    ids = spark.range(ROWS * COLUMNS).select(F.col("id").alias("cell_id"), F.floor(F.col("id") / COLUMNS).cast("int").alias("grid_row"), F.pmod("id", F.lit(COLUMNS)).cast("int").alias("grid_col"))
    placed = ids.withColumns({"lat": latitude(F.col("grid_row")), "lon": longitude(F.col("grid_col"))})
    return placed.withColumn("w", area_weight(F.col("lat")))


def equal_earth(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x and y of the Equal Earth projection (Savric, Patterson and Jenny 2018), in radians of the unit sphere."""
    # fixed values: the projection's polynomial
    a1, a2, a3, a4 = 1.340264, -0.081106, 0.000893, 0.003796
    t = F.asin(F.lit(3**0.5 / 2) * F.sin(F.radians(lat)))
    t2 = t * t
    t6 = t2 * t2 * t2
    x = F.radians(lon) * F.cos(t) * (2 * 3**0.5) / (3 * (a1 + 3 * a2 * t2 + t6 * (7 * a3 + 9 * a4 * t2)))
    return x, t * (a1 + a2 * t2 + t6 * (a3 + a4 * t2))


def equal_earth_inverse(x: Column, y: Column, rounds: int = 8) -> tuple[Column, Column]:
    """Longitude and latitude in degrees, by Newton's method; NULL off the map, whose edge counts as on it however it is rounded."""
    a1, a2, a3, a4 = 1.340264, -0.081106, 0.000893, 0.003796

    def step(t: Column, _: Column) -> Column:
        t2 = t * t
        t6 = t2 * t2 * t2
        return t - (t * (a1 + a2 * t2 + t6 * (a3 + a4 * t2)) - y) / (a1 + 3 * a2 * t2 + t6 * (7 * a3 + 9 * a4 * t2))

    t = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), y, step)
    t2 = t * t
    t6 = t2 * t2 * t2
    sine = F.sin(t) * (2 / 3**0.5)
    lon = F.degrees(x * 3 * (a1 + 3 * a2 * t2 + t6 * (7 * a3 + 9 * a4 * t2)) / (2 * 3**0.5 * F.cos(t)))
    inside = (F.abs(sine) <= 1 + 1e-12) & (F.abs(lon) <= 180 + 1e-9)
    held = lambda v, most: F.greatest(F.least(v, F.lit(most)), F.lit(-most))
    return F.when(inside, held(lon, 180.0)), F.when(inside, F.degrees(F.asin(held(sine, 1.0))))
