"""Values: missing ones, ratios, packing to small numbers, months and interpolation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a fraction of one is as a packed number.
SCALE = 10_000


def clean(value: Column) -> Column:
    """Missing values as NULL: NaN, the infinities and negative fills. NULL, as NaN is larger than all numbers to Spark."""
    wide = value.cast("double")
    return F.when(~F.isnan(wide) & (wide >= 0) & (wide < F.lit(float("inf"))), value)


def exceeds(value: Column, threshold: Column) -> Column:
    """Strictly above; never where either is missing."""
    return F.coalesce(value > threshold, F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def packed(fraction: Column) -> Column:
    """0 to SCALE, halves to even; missing ones are 0."""
    return F.rint(F.least(F.greatest(F.coalesce(F.nanvl(fraction, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * SCALE).cast("int")


def unpacked(number: Column) -> Column:
    return number / float(SCALE)


def days_in_month(year: Column, month: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))


def month_index(year: Column, month: Column, first_year: Column) -> Column:
    return (year - first_year) * 12 + month - 1


def month_label(index: Column, first_year: Column) -> tuple[Column, Column]:
    """(year, month) of a month's index."""
    return (first_year + F.floor(index / 12)).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int")


def day_within(index: Column, first_year: Column, fraction: float = 0.5) -> Column:
    """The day a fraction of the way through a month."""
    year, month = month_label(index, first_year)
    return F.date_add(F.make_date(year, month, F.lit(1)), F.floor(days_in_month(year, month) * fraction).cast("int"))


def share_of_month(days: Column, observed: Column) -> Column:
    """Of the days observed; of 30 where none is recorded."""
    return days / F.greatest(F.coalesce(F.nullif(observed, F.lit(0)), F.lit(30)), F.lit(1))


def mix(a: Column, b: Column, part: float) -> Column:
    return a * (1 - part) + b * part
