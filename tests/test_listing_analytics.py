import pytest
from pyrelake.operators import analytics, listing


def test_a_trend_of_known_slope(spark):
    rows = [(w, "p90", y, b * (y - 2000) + e) for w, b in (("observed", 0.2), ("counterfactual", 0.1)) for y, e in zip(range(2000, 2010), [0.1, -0.1] * 5, strict=True)]
    df = spark.createDataFrame(rows, "world string, threshold string, year int, percent double")
    got = {r.world: r for r in analytics.trends(df).collect()}
    assert got["observed"].slope == pytest.approx(2.0, abs=0.1) and got["observed"].slope_se == pytest.approx(got["counterfactual"].slope_se)
    share = analytics.attributable(analytics.trends(df)).first()
    assert share.attributable_share == pytest.approx(0.5, abs=0.05)
    assert analytics.trends(df.where("year < 2002")).first().slope_se is None


def test_worlds_side_by_side_keep_what_one_lacks(spark):
    df = spark.createDataFrame([("observed", 1, 2.0), ("counterfactual", 1, 0.5), ("observed", 2, 1.0)], "world string, k int, v double")
    assert sorted(map(tuple, analytics.side_by_side(df, ["k"], "v").collect())) == [(1, 2.0, 0.5, 1.5), (2, 1.0, None, None)]


def test_means_divide_by_the_years_asked_for(spark):
    counts = spark.createDataFrame([("observed", 2000, 1, 1, "p90", 6)], "world string, year int, month int, cell_id long, threshold string, days long")
    assert analytics.mean_days(counts, [2000, 2001, 2002]).first().days_per_year == 2.0


def test_files_are_digested_and_ordered(spark, tmp_path):
    import hashlib

    (tmp_path / "a.nc").write_bytes(b"abc")
    r = listing.digests(spark, str(tmp_path)).first()
    assert (r.path, r.size, r.sha256) == ("a.nc", 3, hashlib.sha256(b"abc").hexdigest())
    wanted = spark.createDataFrame([(2000,), (2001,)], "year int")
    present = spark.createDataFrame([("x_2000.nc",)], "path string")
    assert [x.year for x in listing.missing_files(wanted, present).collect()] == [2001]


def test_states_of_files(spark):
    files = spark.createDataFrame([(p, 10, d) for p, d in (("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", None), ("f", "x"))], "path string, size long, sha256 string")
    local = spark.createDataFrame([("b", 9, "x"), ("c", 10, "x"), ("d", 10, "y"), ("e", 10, "y"), ("f", 11, None)], "path string, size long, sha256 string")
    assert {r.path: r.status for r in listing.status(files, local).collect()} == {"a": "missing", "b": "partial", "c": "verified", "d": "corrupt", "e": "complete-unverified", "f": "complete-unverified"}


def test_a_path_is_one_local_file(spark):
    """Listed twice it is two rows; there twice it is refused."""
    files = spark.createDataFrame([("a", 10, "x"), ("a", 10, "y"), ("b", 10, "x")], "path string, size long, sha256 string")
    local = spark.createDataFrame([("a", 10, "x")], "path string, size long, sha256 string")
    assert sorted(map(tuple, listing.status(files, local).collect())) == [("a", "corrupt"), ("a", "verified"), ("b", "missing")]
    with pytest.raises(Exception, match="a: more than one local file"):
        listing.status(files, local.union(local)).collect()
