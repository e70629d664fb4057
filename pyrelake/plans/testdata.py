"""The engine's relations from the tables of a star schema, so that every query has data to run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BURNABLE, Settings, Years
from ..functions.grid import area_weight

SETTINGS = Settings(reference=Years(1995, 1999))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    placed = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("cell_id"), ((F.col("s_suppkey") * 37) % 721).alias("grid_row"), ((F.col("s_suppkey") * 101) % 1440).alias("grid_col"),
        F.col("n_regionkey").cast("int").alias("region"), (F.col("s_nationkey") % 21).alias("cls"),
    )
    placed = placed.withColumns({"lat": 90.0 - 0.25 * F.col("grid_row"), "lon": -180.0 + 0.25 * F.col("grid_col"), "burnable": F.col("cls").isin(*BURNABLE)})
    return placed.withColumn("w", area_weight(F.col("lat")))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """(world, date, cell_id, fwi): a cell's largest price of a day, in thousands."""
    l = table(spark, sf, "lineitem")  # noqa: E741
    world = F.when(F.col("l_linestatus") == "O", "observed").otherwise("counterfactual")
    return l.groupBy(world.alias("world"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("cell_id")).agg((F.max("l_extendedprice") / 1000.0).cast("float").alias("fwi"))


def events_daily(spark: SparkSession, sf: str) -> DataFrame:
    """(date, cell_id, fwi) with some values beyond all bins."""
    return table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("date"), F.col("user_id").alias("cell_id")).agg(F.max("value").cast("float").alias("fwi"))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
