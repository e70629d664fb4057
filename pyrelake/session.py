"""The session that the engine's plans expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "pyrelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; give conf with _ for . (spark_sql_shuffle_partitions="8")."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # ranges of days and cells reach the gridded files
        "spark.sql.python.filterPushdown.enabled": "true",
        # a year's partition is replaced as a whole when it is run again
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("_", "."): v for k, v in conf.items()}
    for k, v in wanted.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
