"""Answers: annual means, trends, what the two worlds differ by, synchronous days, months between frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import mix, month_index, share_of_month


def annual(whole: DataFrame) -> DataFrame:
    """(world, threshold, year, percent): the mean over days of the share of burnable area above the threshold."""
    return whole.groupBy("world", "threshold", F.year("date").alias("year")).agg((F.avg("fraction") * 100).alias("percent"))


def side_by_side(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, observed, counterfactual, gap: worlds beside each other by one aggregation; NULL where one is missing."""
    world = lambda w: F.max(F.when(F.col("world") == w, F.col(value))).alias(w)
    return df.groupBy(*keys).agg(world("observed"), world("counterfactual")).withColumn("gap", F.col("observed") - F.col("counterfactual"))


def period(year: Column, bounds: list[tuple[int, int]]) -> Column:
    """'1995-1996' for a year in one of the bounds, else NULL."""
    out = F.lit(None).cast("string")
    for a, b in bounds:
        out = F.when(year.between(a, b), f"{a}-{b}").otherwise(out)
    return out


def period_means(years: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """(threshold, period, observed, counterfactual, gap) of annual percentages."""
    means = years.withColumn("period", period(F.col("year"), bounds)).where("period IS NOT NULL").groupBy("world", "threshold", "period").agg(F.avg("percent").alias("percent"))
    return side_by_side(means, ["threshold", "period"], "percent")


def mean_days(counts: DataFrame, years: list[int]) -> DataFrame:
    """(world, cell_id, threshold, days_per_year): by the number of years asked for, also where a year is absent."""
    return counts.where(F.col("year").isin(*years)).groupBy("world", "cell_id", "threshold").agg((F.sum("days") / float(len(years))).alias("days_per_year"))


def extra_days(counts: DataFrame, cells: DataFrame, years: list[int]) -> DataFrame:
    """(threshold, cell_id, observed, counterfactual, gap) in burnable cells; a world without a count has none."""
    return side_by_side(mean_days(counts.join(cells.where("burnable").select("cell_id"), "cell_id", "left_semi"), years), ["threshold", "cell_id"], "days_per_year")


def gap_statistics(gaps: DataFrame) -> DataFrame:
    """(threshold, cells, mean_gap, p99_abs_gap) over cells that both worlds have."""
    return gaps.where("gap IS NOT NULL").groupBy("threshold").agg(F.count("*").alias("cells"), F.avg("gap").alias("mean_gap"), F.percentile(F.abs("gap"), F.lit(0.99)).alias("p99_abs_gap"))


def top_gaps(gaps: DataFrame, k: int) -> DataFrame:
    """Of each threshold the k cells of the largest gap; ties by cell."""
    place = F.row_number().over(Window.partitionBy("threshold").orderBy(F.desc("gap"), "cell_id"))
    return gaps.where("gap IS NOT NULL").withColumn("place", place).where(F.col("place") <= k).drop("place")


def trends(years: DataFrame) -> DataFrame:
    """(world, threshold, slope, slope_se) per decade, by least squares over years; NULL errors with fewer than three."""
    y, x = F.col("percent"), F.col("year").cast("double")
    fit = years.groupBy("world", "threshold").agg(F.regr_slope(y, x).alias("b"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"), F.regr_sxx(y, x).alias("sxx"), F.regr_count(y, x).alias("n"))
    rest = F.greatest((F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")) / (F.col("n") - 2) / F.col("sxx"), F.lit(0.0))
    return fit.select("world", "threshold", (F.col("b") * 10).alias("slope"), (F.when(F.col("n") > 2, F.sqrt(rest)) * 10).alias("slope_se"))


def attributable(slopes: DataFrame) -> DataFrame:
    """(threshold, observed, counterfactual, gap, attributable_share): one less the ratio of the slopes."""
    return side_by_side(slopes, ["threshold"], "slope").withColumn("attributable_share", 1 - F.try_divide("counterfactual", "observed"))


def synchronous_days(regions: DataFrame, least: float = 0.3) -> DataFrame:
    """(world, threshold, region, year, days) on which at least so much of a region is above its threshold."""
    return regions.groupBy("world", "threshold", "region", F.year("date").alias("year")).agg(F.count_if(F.col("fraction") >= least).alias("days"))


def synchrony_factor(days: DataFrame, early: tuple[int, int], late: tuple[int, int]) -> DataFrame:
    """(world, threshold, region, early, late, factor): mean days a year of two periods."""
    mean = lambda a, b: F.avg(F.when(F.col("year").between(a, b), F.col("days")))
    return days.groupBy("world", "threshold", "region").agg(mean(*early).alias("early"), mean(*late).alias("late")).withColumn("factor", F.try_divide("late", "early"))


def coverage_by_month(whole: DataFrame) -> DataFrame:
    return whole.groupBy("world", "threshold", F.month("date").alias("month")).agg(F.avg("coverage").alias("coverage"), F.avg("fraction").alias("fraction"), F.avg("fraction_observed").alias("fraction_observed"))


def monthly_shares(counts: DataFrame, observed: DataFrame, first_year: int) -> DataFrame:
    """counts with month_idx and share: days above the threshold by days observed."""
    joined = counts.join(observed.withColumnRenamed("days", "of"), ["world", "year", "month"], "left")
    return joined.withColumns({"month_idx": month_index(F.col("year"), F.col("month"), F.lit(first_year)), "share": share_of_month(F.col("days"), F.col("of"))}).drop("of")


def between_months(shares: DataFrame, part: float) -> DataFrame:
    """value: part of the way from each month to the next; the last stays as it is."""
    after = F.lead("share").over(Window.partitionBy("world", "cell_id", "threshold").orderBy("month_idx"))
    return shares.withColumn("value", mix(F.col("share"), F.coalesce(after, F.col("share")), part))


def readout(whole: DataFrame, threshold: str) -> DataFrame:
    """(date, observed, counterfactual, gap) in percent with one decimal, the gap in points."""
    both = side_by_side(whole.where(F.col("threshold") == threshold), ["date"], "fraction")
    return both.select("date", *[F.round(F.col(c) * 100, 1).alias(c) for c in ("observed", "counterfactual", "gap")])


def spells(hits: DataFrame, names: list[str]) -> DataFrame:
    """(world, cell_id, threshold, first_day, last_day, days): consecutive days of a cell above a threshold, as long as they last.

    hits is as exceedance.compared() gives it. A session of days less than a day and a half apart is a spell, so
    batches and streams (with a watermark on event_time) have them alike; a day is expected once a cell.
    """
    timed = hits if "event_time" in hits.columns else hits.withColumn("event_time", F.col("date").cast("timestamp"))
    above = F.filter(F.array(*[F.when(F.col(f"hit_{n}"), F.lit(n)) for n in names]), lambda n: n.isNotNull())
    days = timed.select("world", "cell_id", "date", "event_time", F.explode(above).alias("threshold"))
    runs = days.groupBy("world", "cell_id", "threshold", F.session_window("event_time", "36 hours")).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("days"))
    return runs.select("world", "cell_id", "threshold", "first_day", "last_day", "days")


def spell_statistics(found: DataFrame) -> DataFrame:
    """(world, threshold, year, spells, days, longest) of spells by the year that they begin in."""
    return found.groupBy("world", "threshold", F.year("first_day").alias("year")).agg(F.count("*").alias("spells"), F.sum("days").alias("days"), F.max("days").alias("longest"))
