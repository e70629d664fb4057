import datetime as dt

import pytest
from pyrelake.operators import calendar as cal


def days(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "date date")


def year(y, skip=()):
    first = dt.date(y, 1, 1)
    return [d for i in range((dt.date(y, 12, 31) - first).days + 1) if (d := first + dt.timedelta(i)) not in skip]


def test_tails_and_holes(spark):
    tail = days(spark, *year(2021)[:3])
    assert [r.verdict for r in cal.year_verdicts(tail).collect()] == ["short tail"]
    hole = days(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 3))
    assert [r.verdict for r in cal.year_verdicts(hole).collect()] == ["hole at 2021-01-02"]
    cal.require_complete(tail, allow_short_tail=True)
    with pytest.raises(cal.Refused, match="short tail"):
        cal.require_complete(tail)
    with pytest.raises(cal.Refused, match="hole at 2021-01-02"):
        cal.require_complete(hole, allow_short_tail=True)


def test_a_leap_year_without_its_last_day(spark):
    last = dt.date(2020, 12, 31)
    c = cal.coverage(days(spark, *year(2020, {last}))).first()
    assert c.missing_days == [last] and c.n_days == 365 and c.years == [2020]
    assert [r.verdict for r in cal.year_verdicts(days(spark, *year(2019), *year(2020))).collect()] == ["complete"] * 2


def test_gaps_duplicates_and_missing_years(spark):
    some = days(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 2), dt.date(2021, 1, 4))
    assert [(r.date, r.step) for r in cal.day_gaps(some).collect()] == [(dt.date(2021, 1, 4), 2)]
    assert [r.date for r in cal.missing_days(some, cal.between_ends(some)).collect()] == [dt.date(2021, 1, 3)]
    assert [(r.date, r.n) for r in cal.duplicate_days(some.union(some.limit(1))).collect()] == [(dt.date(2021, 1, 1), 2)]
    years = spark.createDataFrame([(1999,), (2002,)], "year int")
    assert sorted(r.year for r in cal.missing_years(years).collect()) == [2000, 2001]
    mixed = spark.createDataFrame([(2021, dt.date(2020, 12, 31)), (2021, dt.date(2021, 1, 1))], "year int, date date")
    assert [r.date for r in cal.other_years(mixed).collect()] == [dt.date(2020, 12, 31)]
    none = days(spark)
    assert cal.day_gaps(none).collect() == [] and cal.missing_days(none, cal.between_ends(none)).collect() == []


def test_days_of_the_year(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(2020, 60), (2021, 60), (2020, 366)], "y int, n int").select(cal.day_of_year(F.col("y"), F.col("n")).alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2020, 2, 29), dt.date(2021, 3, 1), dt.date(2020, 12, 31)]
