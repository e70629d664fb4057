"""Where things are, and how they are written: a year is the unit that is replaced when it is run again."""

from __future__ import annotations

import json
import re
from dataclasses import asdict

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators.listing import file_system


class Layout:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    daily = property(lambda self: f"{self.root}/daily")
    masks = property(lambda self: f"{self.root}/masks")
    region_names = property(lambda self: f"{self.root}/region_names")
    monthly = property(lambda self: f"{self.root}/monthly")
    observed = property(lambda self: f"{self.root}/days_observed")
    extent = property(lambda self: f"{self.root}/extent")
    bundle = property(lambda self: f"{self.root}/bundle")
    manifest = property(lambda self: f"{self.root}/bundle/manifest")

    def by_cell(self, world: str) -> str:
        return f"{self.root}/by_cell/{world}"

    def thresholds(self, settings: Settings) -> str:
        return f"{self.root}/thresholds_{settings.reference.first}_{settings.reference.last}"


    def stored_thresholds(self, spark: SparkSession, settings: Settings, years: str | None = None) -> str:
        """Thresholds of the years FIRST-LAST; without any, the reference period's or, where these are not stored, the latest."""
        if years:
            return f"{self.root}/thresholds_{years.replace('-', '_')}"
        own = self.thresholds(settings)
        system, inner = file_system(self.root)
        names = sorted(x.base_name for x in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if re.fullmatch(r"thresholds_\d{4}_\d{4}", x.base_name))
        return own if own.rsplit("/", 1)[-1] in names or not names else f"{self.root}/{names[-1]}"


def write_years(df: DataFrame, path: str) -> None:
    """By world and year: partitions that df has are replaced, others stay. Rows are dealt out by what they are stored by."""
    df.repartition("world", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("world", "year").parquet(path)


def write_thresholds(df: DataFrame, path: str, settings: Settings, coverage: DataFrame) -> None:
    """With a table beside it of what they were made from, one row of JSON."""
    df.write.mode("overwrite").parquet(path)
    made = coverage.select(F.to_json(F.struct(*coverage.columns, F.lit(json.dumps(asdict(settings))).alias("settings"))).alias("value"))
    made.coalesce(1).write.mode("overwrite").text(f"{path}.provenance")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def stored_text(spark: SparkSession, path: str) -> str | None:
    """What write_text() wrote; None if there is nothing."""
    try:
        return spark.read.text(path, wholetext=True).first().value
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def years_stored(spark: SparkSession, path: str, world: str) -> list[int]:
    return sorted(r.year for r in spark.read.parquet(path).where(F.col("world") == world).select("year").distinct().collect())
