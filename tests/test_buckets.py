"""Days laid out by cell: the same rows, and no exchange of them."""

import contextlib
import datetime as dt
import io

import pytest
from pyrelake.config import Bins
from pyrelake.operators import calendar, exceedance, histogram
from pyrelake.sources import buckets

SCHEMA = "date date, cell_id long, fwi float, year int"


def days(spark, years, add=0.0):
    rows = [(dt.date(y, 1, 1) + dt.timedelta(k), c, float((k * 7 + c) % 90) + add, y) for y in years for k in range(60) for c in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def exchanges(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return [line.strip() for line in out.getvalue().splitlines() if "Exchange" in line]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "by_cell" / "observed")
    assert buckets.arrange(days(spark, (2001, 2002)), path, 4) == 4
    yield path
    buckets.forget(spark, path)


def test_years_are_replaced_and_added(spark, stored):
    buckets.arrange(days(spark, (2002, 2003), 5.0), stored)
    with pytest.raises(ValueError, match="4 buckets"):
        buckets.arrange(days(spark, (2003,)), stored, 8)
    buckets.forget(spark, stored)  # as in another session
    got = buckets.opened(spark, stored)
    want = days(spark, (2001,)).unionByName(days(spark, (2002, 2003), 5.0))
    assert sorted(map(tuple, got.select("date", "cell_id", "fwi", "year").collect())) == sorted(map(tuple, want.collect()))
    assert buckets.opened(spark, stored + "x") is None


def test_sums_by_cell_exchange_no_daily_rows(spark, stored):
    daily, bins = buckets.opened(spark, stored), Bins()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(exchanges(histogram.histogram(days(spark, (2001, 2002)), bins))) == 1
        hist = histogram.histogram(daily, bins)
        wide = histogram.wide_quantiles(hist, (0.9, 0.99), bins)
        assert exchanges(hist) == [] and exchanges(wide) == [] and exchanges(calendar.cell_months(daily)) == []
        # of a join with a few thresholds only these are dealt out
        other = spark.createDataFrame([(c, 40.0) for c in range(40)], "cell_id long, p90 float")
        hits = exceedance.compared(daily.selectExpr("'observed' AS world", "date", "cell_id", "fwi"), other, ["p90"])
        assert len(exchanges(exceedance.month_sums(hits, ["p90"]))) == 1
        plain = days(spark, (2001, 2002))
        assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, histogram.wide_quantiles(histogram.histogram(plain, bins), (0.9, 0.99), bins).collect()))
        assert sorted(map(tuple, hist.collect())) == sorted(map(tuple, histogram.histogram(plain, bins).collect()))
        assert daily.where("year = 2002").count() == 60 * 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_number_of_buckets_grows_with_a_year(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS", 100)
    assert buckets.buckets_for(days(spark, (2001, 2002))) == 32 and buckets.buckets_for(days(spark, (2001,)).limit(0)) == 1
