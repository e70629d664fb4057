import numpy as np
import pytest
from pyrelake.config import Bins
from pyrelake.operators.histogram import bin_of, histogram, merged, quantiles, refused_counts, samples, wide_thresholds
from pyrelake.functions.values import clean
from pyspark.sql import functions as F

BINS = Bins()
NARROW = Bins(coarse_max=200.0)


def cube(spark, values):
    """values: (cells, n)"""
    rows = [(c, float(v)) for c, own in enumerate(values) for v in own]
    return spark.createDataFrame(rows, "cell_id long, v double").select("cell_id", clean(F.col("v").cast("float")).alias("fwi"))


def thresholds(spark, values, qs, bins=BINS):
    out = {(r.cell_id, r.q): r.thr for r in quantiles(histogram(cube(spark, values), bins), qs, bins).collect()}
    return np.array([[out[c, q] for q in qs] for c in range(len(values))])


def test_bins_agree_with_the_edges(spark):
    edges = np.concatenate([np.arange(400) * 0.2, 80 + np.arange(220), [300.0]])
    near = np.concatenate([edges, np.nextafter(edges, 0), np.nextafter(edges, 400), np.random.default_rng(1).uniform(0, 310, 5000)])
    want = np.clip(np.searchsorted(edges, near, side="right") - 1, 0, 620)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(near)], "i long, v double").select("i", bin_of(F.col("v"), BINS).alias("b"))
    assert [r.b for r in df.orderBy("i").collect()] == want.tolist()
    assert BINS.count == 621 and NARROW.count == 521


def test_quantiles_are_near_the_exact_ones(spark):
    values = np.minimum(np.random.default_rng(2).lognormal(2, 0.8, (20, 1000)), 79).astype(np.float32)
    qs = (0.9, 0.95, 0.99)
    got = thresholds(spark, values, qs)
    assert np.abs(got - np.quantile(values, qs, axis=1).T).max() <= 0.2
    assert (np.diff(got, axis=1) >= 0).all()
    coarse = np.random.default_rng(3).uniform(90, 150, (10, 800)).astype(np.float32)
    assert np.abs(thresholds(spark, coarse, (0.9,)) - np.quantile(coarse, (0.9,), axis=1).T).max() <= 1.0


def test_missing_values_do_not_count(spark):
    df = cube(spark, [[1.0, np.nan, np.nan], [3.0, 5.0, np.nan], [np.nan, -3.4e38, np.inf]])
    hist = histogram(df, BINS)
    assert {r.cell_id: r.n_samples for r in samples(hist, BINS).collect()} == {0: 1, 1: 2}
    assert {r.cell_id for r in quantiles(hist, (0.5,), BINS).collect()} == {0, 1}


def test_overflow_is_flagged_and_gives_the_maximum(spark):
    df = cube(spark, [[250.0] * 10, [10.0] * 10])
    hist = histogram(df, NARROW)
    assert {r.cell_id: r.overflow for r in samples(hist, NARROW).collect()} == {0: True, 1: False}
    assert thresholds(spark, [[250.0] * 10], (0.5,), NARROW)[0][0] == 200.0


def test_a_constant_lies_below_its_threshold(spark):
    assert 30 < thresholds(spark, [[30.0] * 50], (0.9,))[0][0] <= 30.2 + 1e-6


def test_going_on_from_a_saved_histogram(spark):
    values = np.random.default_rng(4).uniform(0, 320, (5, 60))
    whole = {(r.cell_id, r.bin): r.n for r in histogram(cube(spark, values), BINS).collect()}
    parts = merged(histogram(cube(spark, values[:, :20]), BINS), histogram(cube(spark, values[:, 20:]), BINS))
    assert {(r.cell_id, r.bin): r.n for r in parts.collect()} == whole
    bad = spark.createDataFrame([(1, 5, 2), (1, 700, 1), (2, 3, -1), (3, 1, 1), (3, 1, 2)], "cell_id long, bin long, n long")
    assert sorted(tuple(r) for r in refused_counts(bad, BINS).collect()) == [(1, 700, 1), (2, 3, -1), (3, 1, 1), (3, 1, 2)]


def test_wide_thresholds(spark):
    values = np.random.default_rng(5).uniform(0, 50, (3, 40))
    long = quantiles(histogram(cube(spark, values), BINS), (0.9, 0.99), BINS)
    wide = {r.cell_id: (r.p90, r.p99) for r in wide_thresholds(long, ["p90", "p99"]).collect()}
    assert wide == {c: tuple({r.q: r.thr for r in long.collect() if r.cell_id == c}[q] for q in (0.9, 0.99)) for c in range(3)}


@pytest.mark.parametrize("kind", ["empty"])
def test_empty(spark, kind):
    none = spark.createDataFrame([], "cell_id long, fwi float")
    assert quantiles(histogram(none, BINS), (0.9,), BINS).collect() == []
