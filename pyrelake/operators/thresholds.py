"""Thresholds of a reference period and how exact they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.names import quantile_name
from .histogram import histogram, long_thresholds, quantiles, samples


def reference(daily: DataFrame, settings: Settings) -> DataFrame:
    """The observed days of the reference period; the other world is held against the same thresholds."""
    return daily.where((F.col("world") == "observed") & F.year("date").between(settings.reference.first, settings.reference.last))


def thresholds(daily: DataFrame, settings: Settings) -> DataFrame:
    """(cell_id, threshold, q, thr, n_samples, overflow)."""
    hist = histogram(reference(daily, settings), settings.bins)
    return quantiles(hist, settings.quantiles, settings.bins).join(samples(hist, settings.bins), "cell_id")


def exact(daily: DataFrame, qs: tuple[float, ...]) -> DataFrame:
    """(cell_id, threshold, q, thr) from the values themselves: for samples, as each cell's values are held together."""
    wide = daily.where("fwi IS NOT NULL").groupBy("cell_id").agg(*[F.percentile(F.col("fwi").cast("double"), F.lit(q)).alias(quantile_name(q)) for q in qs])
    return long_thresholds(wide, qs)


def validation_cells(daily: DataFrame, settings: Settings) -> DataFrame:
    """Cells with a value on the first day, in an order that the seed and the cell's hash give; at most so many."""
    first = daily.agg(F.min("date").alias("date"))
    return daily.where("fwi IS NOT NULL").join(F.broadcast(first), "date").select("cell_id").distinct().orderBy(F.md5(F.concat(F.lit(f"{settings.seed}:"), F.col("cell_id").cast("string"))), "cell_id").limit(settings.validation_cells)


def validation(daily: DataFrame, settings: Settings) -> DataFrame:
    """(threshold, n_cells, n_samples, max_err, mean_err, p99_err) of estimates against exact percentiles in sampled cells."""
    ref = reference(daily, settings)
    some = ref.join(validation_cells(ref, settings), "cell_id", "left_semi")
    true = exact(some, settings.quantiles).withColumnRenamed("thr", "exact").drop("q")
    found = thresholds(some, settings).join(true, ["cell_id", "threshold"])  # of the sampled cells alone
    err = F.abs(F.col("thr").cast("double") - F.col("exact"))
    return found.groupBy("threshold").agg(F.count("*").alias("n_cells"), F.sum("n_samples").alias("n_samples"), F.max(err).alias("max_err"), F.avg(err).alias("mean_err"), F.percentile(err, F.lit(0.99)).alias("p99_err"))
