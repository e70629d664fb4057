"""Histograms by cell, and the quantiles they give.

A histogram is rows (cell_id, bin, n): counting is a hash aggregation with partial sums on the map side,
histograms of different years merge by adding, and a cell's quantiles need its few hundred bins, not its values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Bins
from ..functions.names import quantile_name
from .calendar import refuse


def bin_of(value: Column, bins: Bins) -> Column:
    """The bin of a value that is not missing. Edges are whole multiples of the step in double precision, so a
    quotient that rounding moved across one is moved back."""
    v, step = value.cast("double"), F.lit(bins.fine_step)
    k = F.floor(v / step)
    fine = F.when(v < k * step, k - 1).when(v >= (k + 1) * step, F.least(k + 1, F.lit(bins.fine - 1))).otherwise(F.least(k, F.lit(bins.fine - 1)))
    coarse = bins.fine + F.floor((v - bins.fine_max) / bins.coarse_step)
    return F.when(v < 0, 0).when(v >= bins.coarse_max, bins.count - 1).when(v >= bins.fine_max, coarse).otherwise(fine).cast("long")


def lower_edge(b: Column, bins: Bins) -> Column:
    return F.when(b < bins.fine, b * F.lit(bins.fine_step)).otherwise(bins.fine_max + (b - bins.fine) * F.lit(bins.coarse_step))


def width(b: Column, bins: Bins) -> Column:
    """To the next edge; the bin beyond coarse_max has none."""
    last = F.when(b == bins.fine - 1, F.lit(bins.fine_max)).otherwise((b + 1) * F.lit(bins.fine_step))
    return F.when(b == bins.count - 1, 0.0).when(b >= bins.fine, F.lit(bins.coarse_step)).otherwise(last - b * F.lit(bins.fine_step))


def histogram(daily: DataFrame, bins: Bins, value: str = "fwi") -> DataFrame:
    """(cell_id, bin, n) of the values that are not NULL."""
    return daily.where(F.col(value).isNotNull()).groupBy("cell_id", bin_of(F.col(value), bins).alias("bin")).agg(F.count("*").alias("n"))


def merged(*histograms: DataFrame) -> DataFrame:
    """Histograms added up: going on from a saved one is the same as counting all at once."""
    return reduce(DataFrame.unionByName, histograms).groupBy("cell_id", "bin").agg(F.sum("n").alias("n"))


def refused_counts(saved: DataFrame, bins: Bins) -> DataFrame:
    """The rows of a saved histogram that it cannot be restored from: bins or counts out of range, bins given twice."""
    again = Window.partitionBy("cell_id", "bin")
    bad = F.col("bin").isNull() | (F.col("bin") < 0) | (F.col("bin") >= bins.count) | F.col("n").isNull() | (F.col("n") < 0)
    return saved.withColumn("times", F.count("*").over(again)).where(bad | (F.col("times") > 1)).drop("times")


def resumed(saved: DataFrame, more: DataFrame, bins: Bins) -> DataFrame:
    """A saved histogram and more counts; a saved one that is not whole is refused."""
    refuse(refused_counts(saved, bins), "a saved histogram cannot be gone on from")
    return merged(saved, more)


def samples(hist: DataFrame, bins: Bins) -> DataFrame:
    """(cell_id, n_samples, overflow): overflow where a value lies beyond coarse_max, whose bin has no width."""
    return hist.groupBy("cell_id").agg(F.sum("n").alias("n_samples"), (F.max("bin") == bins.count - 1).alias("overflow"))


def quantiles(hist: DataFrame, qs: tuple[float, ...], bins: Bins) -> DataFrame:
    """(cell_id, threshold, q, thr)."""
    return long_thresholds(wide_quantiles(hist, qs, bins), qs)


def wide_quantiles(hist: DataFrame, qs: tuple[float, ...], bins: Bins) -> DataFrame:
    """(cell_id, and a column a quantile). The rank q(n-1) lies between two order statistics; each is placed in its bin
    by its place among the bin's values, and the result is between them in proportion. One window, one aggregation."""
    by = Window.partitionBy("cell_id")
    placed = hist.withColumns({"cum": F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(by)})
    placed = placed.withColumns({"before": F.col("cum") - F.col("n"), "edge": lower_edge(F.col("bin"), bins), "wide": width(F.col("bin"), bins)})

    def order_statistic(k: Column) -> Column:
        here = (F.col("before") <= k) & (k < F.col("cum"))
        return F.max(F.when(here, F.col("edge") + (k - F.col("before") + 0.5) / F.col("n") * F.col("wide")))

    parts = []
    for q in qs:
        rank = F.lit(q) * (F.col("total") - 1)
        k = F.floor(rank)
        low, high, rest = order_statistic(k), order_statistic(F.least(k + 1, F.col("total") - 1)), F.max(rank - k)
        parts.append((low + rest * (high - low)).cast("float").alias(quantile_name(q)))
    return placed.groupBy("cell_id").agg(*parts)


def long_thresholds(wide: DataFrame, qs: tuple[float, ...]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(quantile_name(q)).alias("threshold"), F.lit(q).alias("q"), F.col(quantile_name(q)).alias("thr")) for q in qs])
    return wide.select("cell_id", F.explode(rows).alias("r")).select("cell_id", "r.*")


def wide_thresholds(thresholds: DataFrame, names: list[str]) -> DataFrame:
    """A row a cell, a column a threshold: joined to daily values without multiplying them."""
    return thresholds.groupBy("cell_id").pivot("threshold", names).agg(F.first("thr"))
