"""Daily values laid out by cell: every file has all of a year's days of its cells.

Yearly files are day-major: a block of days holds every cell, so whatever is summed by cell shuffles nearly all rows,
each time it is asked for. Arranged once, in as many buckets as are asked for, the rows of a cell are in one bucket in
every year, and sums, windows and joins by cell need no exchange of daily rows any more. Years stay partitions: they
prune, and one that is arranged again replaces itself.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import clean
from .layout import stored_text, write_text

#: Rows of a bucket and year, about, if the number of buckets is left open; a bucket of some hundred cells and a year.
ROWS = 4_000_000
SCHEMA = "date DATE, cell_id BIGINT, fwi FLOAT, year INT"


def buckets_for(daily: DataFrame) -> int:
    """How many buckets keep a year's file of each at ROWS rows, about; a power of two, as joins of such tables can share."""
    most = daily.groupBy("year").count().agg(F.max("count")).first()[0] or 1
    return 1 << max(0, (most // ROWS).bit_length())


def _table(path: str) -> str:
    return "by_cell_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex


def _declared(spark: SparkSession, path: str, buckets: int) -> str:
    name = _table(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet PARTITIONED BY (year) CLUSTERED BY (cell_id) SORTED BY (cell_id, date) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def opened(spark: SparkSession, path: str) -> DataFrame | None:
    """(date, cell_id, fwi, year) of what arrange() stored under a path; None if there is nothing."""
    text = stored_text(spark, f"{path}.buckets")
    if text is None:
        return None
    name = _declared(spark, path, json.loads(text)["buckets"])
    spark.catalog.recoverPartitions(name)
    return spark.table(name).withColumn("fwi", clean(F.col("fwi")))


def arrange(daily: DataFrame, path: str, buckets: int | None = None) -> int:
    """Stores the years of daily (date, cell_id, fwi, year), one world's; years that are there already are replaced. Gives the number of buckets.

    What is stored keeps its number of buckets; another is refused.
    """
    spark = daily.sparkSession
    text = stored_text(spark, f"{path}.buckets")
    before = json.loads(text)["buckets"] if text else None
    if before and buckets and before != buckets:
        raise ValueError(f"{path} has {before} buckets, not {buckets}")
    buckets = before or buckets or buckets_for(daily)
    name = _declared(spark, path, buckets)
    if before:
        spark.catalog.recoverPartitions(name)
    # dealt out as buckets are, so that a bucket is a file a year
    rows = daily.select("date", "cell_id", "fwi", "year").repartition(buckets, "cell_id")
    mode = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, was)
    if not before:
        write_text(spark, json.dumps({"buckets": buckets}), f"{path}.buckets")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return buckets


def forget(spark: SparkSession, path: str) -> None:
    """Drops the session's table over a path; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
