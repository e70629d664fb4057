"""Readers: daily values, masks, thresholds and packed tables, brought to the engine's columns and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.grid import ROWS, COLUMNS, cell_of, column_of, latitude, longitude, row_of
from ..functions.values import clean
from ..operators.calendar import refuse

DAILY = T.StructType([
    T.StructField("world", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("date", T.DateType()),
    T.StructField("cell_id", T.LongType()), T.StructField("fwi", T.FloatType()),
])
MASKS = "cell_id long, burnable boolean, region int, w double"
THRESHOLDS = "cell_id long, threshold string, q double, thr float, n_samples long, overflow boolean"
#: Names of the value among a file's variables, and of the axes.
VARIABLES, LATITUDES, LONGITUDES, TIMES = ("fwi", "fwi_era5", "fwinx", "fire_weather_index"), ("lat", "latitude"), ("lon", "longitude"), ("time", "t", "date", "day")


def find(columns: list[str], names: tuple[str, ...]) -> str | None:
    """The first of the columns, whatever its case, that has one of the names."""
    return next((c for n in names for c in columns if c.lower() == n.lower()), None)


def find_variable(schema: T.StructType, allow_unnamed: bool = False) -> str:
    """A known name; only if asked for, the one other numeric column there is."""
    if name := find(schema.names, VARIABLES):
        return name
    axes = {x.lower() for x in (*LATITUDES, *LONGITUDES, *TIMES, "world", "year", "source")}
    others = [f.name for f in schema if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name.lower() not in axes]
    if allow_unnamed and len(others) == 1:
        return others[0]
    raise ValueError(f"no known variable among {schema.names}")


def off_grid(values: DataFrame) -> DataFrame:
    """Distinct coordinates (lat, lon) that are more than 1e-4 from a node."""
    lat, lon = F.col("lat"), F.col("lon")
    row, column = row_of(lat), column_of(lon)
    far = (F.abs(latitude(row) - lat) > 1e-4) | (F.abs(F.pmod(longitude(column) - lon + 180.0, F.lit(360.0)) - 180.0) > 1e-4) | ~row.between(0, ROWS - 1)
    return values.where(far | lat.isNull() | lon.isNull()).select("lat", "lon").distinct()


def canonical(values: DataFrame, allow_unnamed: bool = False) -> DataFrame:
    """Points with latitude and longitude axes of any usual name, order and origin: lat and lon become cell_id, the value fwi."""
    lat, lon = find(values.columns, LATITUDES), find(values.columns, LONGITUDES)
    if not (lat and lon):
        raise ValueError(f"no latitude and longitude among {values.columns}")
    name = find_variable(values.schema, allow_unnamed)
    rest = [c for c in values.columns if c not in (lat, lon, name)]
    points = values.select(*rest, F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), F.col(name).cast("float").alias("fwi"))
    cell = cell_of(row_of(F.col("lat")), F.pmod(column_of(F.col("lon")), F.lit(COLUMNS))).cast("long")
    return points.select(*rest, "lat", "lon", cell.alias("cell_id"), clean(F.col("fwi")).alias("fwi"))


def check_canonical(values: DataFrame) -> DataFrame:
    """values of canonical() if all are on the grid; raises otherwise."""
    refuse(off_grid(values), "coordinates off the grid")
    return values.drop("lat", "lon")


def incomplete_slabs(values: DataFrame, cells: int = ROWS * COLUMNS) -> DataFrame:
    """(date, n) of days that do not have every cell once."""
    return values.groupBy("date").agg(F.count("*").alias("n"), F.countDistinct("cell_id").alias("different")).where((F.col("n") != cells) | (F.col("different") != cells)).select("date", "n")


def daily(spark: SparkSession, path: str, world: str | None = None, years: list[int] | None = None) -> DataFrame:
    """Daily values stored by world and year: both prune partitions; fills become NULL."""
    df = spark.read.schema(DAILY).parquet(path)
    if world:
        df = df.where(F.col("world") == world)
    if years is not None:
        df = df.where(F.col("year").isin(*years))
    return df.withColumn("fwi", clean(F.col("fwi")))


def masks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MASKS).parquet(path)


def thresholds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(THRESHOLDS).parquet(path)


def extents(spark: SparkSession, *paths: str) -> DataFrame:
    """Daily tables of many years, one after another."""
    return spark.read.parquet(*paths)
