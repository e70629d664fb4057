import datetime as dt

import pytest
from pyrelake.operators import exceedance as ex

DAY = dt.date(2021, 1, 1)


def run(spark, fwi, thr, w, region=None, burnable=None, ids=None, dates=None):
    n = len(fwi)
    daily = spark.createDataFrame([("observed", DAY, c, v) for c, v in enumerate(fwi)], "world string, date date, cell_id long, fwi float")
    wide = spark.createDataFrame([(c, t) for c, t in enumerate(thr)], "cell_id long, p90 float")
    cells = spark.createDataFrame([(c, (burnable or [True] * n)[c], (region or [1] * n)[c], w[c]) for c in range(n)], "cell_id long, burnable boolean, region int, w double")
    sums = ex.extent(daily, wide, cells, ["p90"], ids or ())
    return {r.region: r for r in ex.fractions(sums, ex.areas(cells), ids).collect()}


def test_area_weights(spark):
    r = run(spark, [20.0, 5.0, 20.0, 20.0], [10.0] * 4, [1.0, 1.0, 0.5, 0.5], burnable=[True, True, True, False])[None]
    assert r.fraction == pytest.approx(0.6) and r.coverage == 1.0


def test_missing_values_keep_their_area(spark):
    r = run(spark, [20.0, None, 5.0, 5.0], [10.0] * 4, [1.0] * 4)[None]
    assert (r.fraction, r.coverage) == (0.25, 0.75) and r.fraction_observed == pytest.approx(1 / 3)


def test_regions_that_the_grid_does_not_have_are_null(spark):
    r = run(spark, [20.0, 5.0, 20.0], [10.0] * 3, [1.0] * 3, region=[1, 1, 2], ids=[1, 2, 14])
    assert (r[1].fraction, r[2].fraction) == (0.5, 1.0) and r[14].fraction is None and r[14].coverage is None


def test_equality_is_not_above_and_a_missing_threshold_is_never_passed(spark):
    assert run(spark, [10.0], [10.0], [1.0])[None].fraction == 0
    assert run(spark, [10.01], [10.0], [1.0])[None].fraction == 1
    assert run(spark, [99.0], [None], [1.0])[None].fraction == 0


def test_the_background_counts_in_the_world_alone(spark):
    r = run(spark, [20.0, 5.0], [10.0] * 2, [1.0] * 2, region=[0, 1], ids=[1])
    assert r[1].fraction == 0
    assert run(spark, [20.0, 5.0], [10.0] * 2, [1.0] * 2, region=[0, 1])[None].fraction == 0.5


def test_a_day_without_values_keeps_its_row(spark):
    r = run(spark, [None, None], [10.0] * 2, [1.0] * 2)[None]
    assert (r.fraction, r.coverage, r.fraction_observed) == (0.0, 0.0, None)


def year(spark, values):
    days = [dt.date(2021, 1, 1) + dt.timedelta(i) for i in range(365)]
    rows = [("observed", d, c, v) for d in days for c, v in enumerate(values)]
    return spark.createDataFrame(rows, "world string, date date, cell_id long, fwi float")


def test_a_year_of_counts(spark):
    daily = year(spark, [15.0, 25.0, None])
    wide = spark.createDataFrame([(c, 10.0, 20.0) for c in range(3)], "cell_id long, p90 float, p99 float")
    got = {(r.month, r.cell_id, r.threshold): r.days for r in ex.monthly(ex.month_sums(ex.compared(daily, wide, ["p90", "p99"]), ["p90", "p99"]), ["p90", "p99"]).collect()}
    assert got[1, 0, "p90"] == 31 and got[2, 0, "p90"] == 28 and got[1, 0, "p99"] == 0
    assert sum(v for (m, c, t), v in got.items() if c == 1 and t == "p99") == 365 and got[5, 2, "p90"] == 0
    assert {r.month: r.days for r in ex.days_observed(daily).collect()}[2] == 28


def test_dense_counts_have_every_cell_and_month(spark):
    counts = spark.createDataFrame([("observed", 2021, 3, 7, "p90", 4)], "world string, year int, month int, cell_id long, threshold string, days long")
    cells, years = spark.createDataFrame([(7,), (8,)], "cell_id long"), spark.createDataFrame([("observed", 2021)], "world string, year int")
    rows = ex.dense_monthly(counts, cells, years, ["p90", "p99"]).collect()
    assert len(rows) == 2 * 12 * 2 and sum(r.days for r in rows) == 4
