"""The same sums over a stream of daily rows: state is a count a cell and bin, or a cell and month, and never a value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Bins
from ..operators.analytics import spells
from ..operators.exceedance import compared, month_sums, monthly
from ..operators.histogram import histogram


def running_histogram(stream: DataFrame, bins: Bins) -> DataFrame:
    """Histogram of all rows so far; write in complete or update mode."""
    return histogram(stream, bins)


def running_monthly(stream: DataFrame, thresholds: DataFrame, names: list[str]) -> DataFrame:
    """Days above the thresholds (wide, static) by month so far. Days may come in any order."""
    return monthly(month_sums(compared(stream, thresholds, names), names), names)


def once_a_day(stream: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Rows that come again within the lateness are dropped. A batch refuses duplicates; a stream cannot wait for all."""
    return stream.withColumn("event_time", F.col("date").cast("timestamp")).withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["world", "cell_id", "date"])


def closed_days(stream: DataFrame, lateness: str = "3 days") -> DataFrame:
    """(world, date, n) of each day, given out once the watermark has passed it: for append mode."""
    timed = stream.withColumn("event_time", F.col("date").cast("timestamp")).withWatermark("event_time", lateness)
    days = timed.groupBy("world", F.window("event_time", "1 day")).agg(F.count("fwi").alias("n"))
    return days.select("world", F.col("window.start").cast("date").alias("date"), "n")


def running_spells(stream: DataFrame, thresholds: DataFrame, names: list[str], lateness: str = "3 days") -> DataFrame:
    """Spells above the thresholds (wide, static), each given out once no day can lengthen it: for append mode."""
    timed = stream.withColumn("event_time", F.col("date").cast("timestamp")).withWatermark("event_time", lateness)
    return spells(compared(timed, thresholds, names), names)


def worlds_as_they_arrive(observed: DataFrame, counterfactual: DataFrame, lateness: str = "30 days") -> DataFrame:
    """(threshold, date, observed, counterfactual, gap) of two streams of daily shares (date, threshold, fraction).

    A day that one world alone has is given out, with the other NULL, once the watermarks of both say that it will
    not come: for append mode. State is the days within the lateness.
    """
    timed = lambda df, x: df.select(F.col("date").cast("timestamp").alias(f"time_{x}"), F.col("threshold").alias(f"threshold_{x}"), F.col("fraction").alias(x)).withWatermark(f"time_{x}", lateness)
    a, b = timed(observed, "observed"), timed(counterfactual, "counterfactual")
    both = a.join(b, F.expr("time_observed = time_counterfactual AND threshold_observed = threshold_counterfactual"), "fullOuter")
    return both.select(F.coalesce("threshold_observed", "threshold_counterfactual").alias("threshold"), F.coalesce("time_observed", "time_counterfactual").cast("date").alias("date"), "observed", "counterfactual", (F.col("observed") - F.col("counterfactual")).alias("gap"))


def to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Runs over what there is now, into a table in memory, and ends."""
    return df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
