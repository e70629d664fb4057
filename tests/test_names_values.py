import datetime as dt

import pytest
from pyrelake.config import Bins, Settings, Years, load
from pyrelake.functions import grid, names, values
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_year_specs():
    assert names.parse_years("1991-1993") == (1991, 1992, 1993) and names.parse_years("2018,1991") == (1991, 2018)
    for bad in ("2020-1991", "x", ""):
        with pytest.raises(ValueError):
            names.parse_years(bad)


def test_names(spark):
    assert [names.quantile_name(q) for q in (0.9, 0.95, 0.995)] == ["p90", "p95", "p100"]
    df = spark.createDataFrame([("a/1999/fwi_2018.nc",), ("b/none.nc",), ("fwi_era5_counter_1995.nc",), ("fwi_era5_1995.nc",)], "p string")
    assert [r.y for r in df.select(names.year_of(F.col("p")).alias("y")).collect()] == [2018, None, 1995, 1995]
    assert [r.w for r in df.select(names.world_of(F.col("p")).alias("w")).collect()] == [None, None, "counterfactual", "observed"]
    for units, want in (("days since 1979-1-2", dt.date(1979, 1, 2)), ("days_since_Jan11900", dt.date(1900, 1, 1)), ("hours since 1900-01-01", None), ("days since 1900-13-41", None)):
        assert one(spark, names.epoch_of(F.lit(units))) == want


def test_files_and_bytes(spark):
    assert names.file_name("observed", 1999) == "fwi_era5_1999.nc"
    assert one(spark, names.world_of(F.lit(names.file_name("counterfactual", 1999)))) == "counterfactual"
    with pytest.raises(ValueError):
        names.file_name("other", 1999)
    assert one(spark, names.text_of(F.lit(bytearray("Süd\0\0".encode())))) == "Süd"


def test_grid(spark):
    assert one(spark, grid.signed_longitude(F.lit(359.75))) == -0.25 and one(spark, grid.signed_longitude(F.lit(180.0))) == -180.0
    assert one(spark, grid.angular_distance(F.lit(179.0), F.lit(-179.0))) == 2.0
    assert 0 <= one(spark, grid.area_weight(F.lit(90.0))) < 1e-15 and one(spark, grid.area_weight(F.lit(60.0))) == pytest.approx(0.5)
    corners = grid.cells(spark).agg(F.count("*"), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert tuple(corners) == (1038240, -90.0, 90.0, -180.0, 179.75)


def test_values(spark):
    assert one(spark, values.clean(F.lit(float("nan")))) is None and one(spark, values.clean(F.lit(-1.0))) is None and one(spark, values.clean(F.lit(0.0))) == 0
    assert one(spark, values.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert [one(spark, values.packed(F.lit(v))) for v in (0.1, 0.101, None, float("nan"), 1.5, -1.0, 0.00005)] == [1000, 1010, 0, 0, 10000, 0, 0]
    assert one(spark, values.days_in_month(F.lit(1900), F.lit(2))) == 28 and one(spark, values.days_in_month(F.lit(2000), F.lit(2))) == 29
    assert one(spark, values.share_of_month(F.lit(15), F.lit(0))) == 0.5 and one(spark, values.share_of_month(F.lit(31), F.lit(31))) == 1.0
    assert one(spark, values.day_within(F.lit(13), F.lit(1979))) == dt.date(1980, 2, 15)


def test_settings(tmp_path):
    assert Settings().names == ["p90", "p95", "p99"] and Bins().count == 621
    for bad in (lambda: Years(2000, 1999), lambda: Settings(quantiles=(1.0,)), lambda: Settings(quantiles=(0.991, 0.992)), lambda: Bins(fine_step=0), lambda: Settings(vote=2), lambda: Bins(fine_max=400)):
        with pytest.raises(ValueError):
            bad()
    text = '[paths]\nroot = "x"\n[archive]\nfirst_year = 1979\nlast_year = 2024\n[reference]\nfirst_year = 1991\nlast_year = 2020\nquantiles = [0.9]\n[histogram]\nfine_max = 80\nfine_step = 0.2\ncoarse_max = 300\ncoarse_step = 1\nvalidation_cells = 10\nseed = 1\n[mask]\nburnable_classes = [1]\nvote_threshold = 0.5\n'
    (tmp_path / "a.toml").write_text(text)
    assert load(tmp_path / "a.toml").reference == Years(1991, 2020)
    (tmp_path / "b.toml").write_text(text.replace("seed = 1\n", ""))
    with pytest.raises(ValueError, match="seed"):
        load(tmp_path / "b.toml")


def test_the_edge_of_the_map_is_on_it(spark):
    """The date line at every row: rounded, it may come out beyond 180 degrees."""
    edge = spark.range(-359, 360).select((F.col("id") / 4).alias("lat"), F.explode(F.array(F.lit(-180.0), F.lit(180.0))).alias("lon"))
    on = edge.select("lat", "lon", *[c.alias(n) for c, n in zip(grid.equal_earth(F.col("lon"), F.col("lat")), "xy", strict=True)])
    back = on.select("lat", "lon", *[c.alias(n) for c, n in zip(grid.equal_earth_inverse(F.col("x"), F.col("y")), ("lon2", "lat2"), strict=True)])
    assert back.where("lon2 IS NULL OR abs(lon2) > 180 OR abs(lon - lon2) > 1e-8 OR lat2 IS NULL OR abs(lat - lat2) > 1e-6").count() == 0
    off = on.where("lat = 10").select(*grid.equal_earth_inverse(F.col("x") * 1.001, F.col("y"))).union(on.where("abs(lat) > 89").select(*grid.equal_earth_inverse(F.col("x") / 2, F.col("y") * 1.01)))
    assert off.count() > 2 and {tuple(r) for r in off.collect()} == {(None, None)}
