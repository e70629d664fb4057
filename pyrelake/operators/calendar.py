"""Calendars: which days are there, which are missing, and what is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Refused(ValueError):
    """Input that a run does not go on with."""


def refuse(df: DataFrame, what: str, show: int = 5) -> None:
    """Raises if df has rows, and names the first."""
    if rows := df.limit(show).collect():
        raise Refused(f"{what}: {', '.join(str(tuple(r)) for r in rows)}")


def duplicate_days(slabs: DataFrame) -> DataFrame:
    """(date, n) of days that come more than once among slabs, a row a slab."""
    return slabs.groupBy("date").agg(F.count("*").alias("n")).where("n > 1")


def days_seen(daily: DataFrame) -> DataFrame:
    return daily.select("date").distinct()


def cell_months(daily: DataFrame) -> DataFrame:
    """(year, month, cell_id, n_rows, day_mask) of one world: a bit for each day of the month that has a row. Where daily has the year of its file, n_foreign counts days of others."""
    bit = F.expr("shiftleft(1, day(date) - 1)")
    foreign = [F.count_if(F.year("date") != F.col("year")).alias("n_foreign")] if "year" in daily.columns else []
    keyed = daily.withColumns({"_year": F.year("date"), "month": F.month("date")})
    return keyed.groupBy("_year", "month", "cell_id").agg(F.count("*").alias("n_rows"), F.bit_or(bit).alias("day_mask"), *foreign).withColumnRenamed("_year", "year")


def doubled(months: DataFrame) -> DataFrame:
    """(year, month, cell_id) that have a day more than once: more rows than bits."""
    return months.where("n_rows > bit_count(day_mask)").select("year", "month", "cell_id")


def days_of(months: DataFrame) -> DataFrame:
    """(date) of the days that any cell has."""
    masks = months.groupBy("year", "month").agg(F.bit_or("day_mask").alias("day_mask"))
    days = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda d: F.getbit("day_mask", d - 1) == 1)
    return masks.select(F.explode(F.transform(days, lambda d: F.make_date("year", "month", d))).alias("date"))


def calendar(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last))


def between_ends(seen: DataFrame) -> DataFrame:
    """Every date from the first to the last seen."""
    return seen.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a IS NOT NULL").select(calendar(F.col("a"), F.col("b")).alias("date"))


def whole_years(seen: DataFrame) -> DataFrame:
    """Every date of the years seen. A year that is missing altogether is for missing_years to find."""
    years = seen.select(F.year("date").alias("y")).distinct()
    return years.select(calendar(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(31))).alias("date"))


def missing_days(seen: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.join(seen, "date", "left_anti")


def day_gaps(seen: DataFrame) -> DataFrame:
    """(prev_date, date, step) where a day does not follow the one before. One small table, ordered as a whole."""
    before = F.lag("date").over(Window.orderBy("date"))
    return seen.select(before.alias("prev_date"), "date").withColumn("step", F.datediff("date", "prev_date")).where("step <> 1")


def year_verdicts(seen: DataFrame) -> DataFrame:
    """(year, n_days, first_missing, hole, verdict): a hole is a missing day between two seen; a short tail is none after.

    Here a year must begin on its first of January.
    """
    by_year = seen.withColumn("year", F.year("date"))
    bounds = by_year.groupBy("year").agg(F.count("*").alias("n_days"), F.max("date").alias("last"))
    absent = missing_days(seen, whole_years(seen)).withColumn("year", F.year("date"))
    first = absent.join(bounds, "year").groupBy("year").agg(F.min("date").alias("first_missing"), F.min(F.when(F.col("date") < F.col("last"), F.col("date"))).alias("hole"))
    out = bounds.join(first, "year", "left")
    verdict = F.when(F.col("hole").isNotNull(), F.concat(F.lit("hole at "), F.col("hole").cast("string"))).when(F.col("first_missing").isNotNull(), "short tail").otherwise("complete")
    return out.select("year", "n_days", "first_missing", "hole", verdict.alias("verdict"))


def require_complete(seen: DataFrame, allow_short_tail: bool = False) -> None:
    bad = year_verdicts(seen).where(F.col("verdict") != "complete")
    refuse((bad.where("hole IS NOT NULL") if allow_short_tail else bad).orderBy("year").select("year", "verdict"), "incomplete years")


def coverage(seen: DataFrame) -> DataFrame:
    """One row: n_days, first_date, last_date, years, missing_days of the years seen."""
    absent = missing_days(seen, whole_years(seen)).agg(F.array_sort(F.collect_list("date")).alias("missing_days"))
    own = seen.agg(F.count("*").alias("n_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.array_sort(F.collect_set(F.year("date"))).alias("years"))
    return own.crossJoin(absent)  # one row each


def missing_years(years: DataFrame) -> DataFrame:
    """(year) between the first and last that are not there."""
    span = years.agg(F.min("year").alias("a"), F.max("year").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("year"))
    return span.join(years, "year", "left_anti")


def other_years(daily: DataFrame) -> DataFrame:
    """Days of a yearly file that are not of its year: (year, date)."""
    return daily.where(F.year("date") != F.col("year")).select("year", "date").distinct()


def day_of_year(year: Column, number: Column) -> Column:
    """The date of a one-based day of the year, as axes with bare numbers give it."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), number - 1)
