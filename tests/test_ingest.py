"""From gridded files to stored days and masks, by the command line."""

import json
from types import SimpleNamespace

import hdf5_files
import numpy as np
from pyrelake.__main__ import main
from pyrelake.sources import gridded
from test_gridded import LAT, LON, write


def settings(path):
    (path / "s.toml").write_text(f'[paths]\nroot = "{path}/data"\n[archive]\nfirst_year = 2001\nlast_year = 2001\n[reference]\nfirst_year = 2001\nlast_year = 2001\nquantiles = [0.9]\n[histogram]\nfine_max = 80\nfine_step = 0.2\ncoarse_max = 300\ncoarse_step = 1\nvalidation_cells = 10\nseed = 1\n[mask]\nburnable_classes = [10]\nvote_threshold = 0.5\n')
    return str(path / "s.toml")


def test_yearly_files_are_stored_by_world_and_year(spark, tmp_path, capsys):
    s, raw = settings(tmp_path), tmp_path / "raw"
    raw.mkdir()
    assert main([s, "ingest", "observed", str(raw)], spark) == 2
    for name, add in (("fwi_era5_2001.nc", 0.0), ("fwi_era5_counter_2001.nc", 5.0), ("other_2002.nc", 9.0)):
        year = name[-7:-3]
        write(raw / name, [0, 1], LAT, LON, np.full((2, 721, 1440), 1.0 + add), f"days since {year}-01-01")
    assert main([s, "ingest", "observed", str(raw)], spark) == 0
    assert main([s, "ingest", "counterfactual", str(raw)], spark) == 0
    assert main([s, "ingest", "observed", str(raw), "--names", "^other_"], spark) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "years: 2001 2002"
    got = spark.read.parquet(f"{tmp_path}/data/daily").groupBy("world", "year").agg({"fwi": "max", "*": "count"}).collect()
    assert {(r.world, r.year): (r["max(fwi)"], r["count(1)"]) for r in got} == {("observed", 2001): (1.0, 2 * 721 * 1440), ("counterfactual", 2001): (6.0, 2 * 721 * 1440), ("observed", 2002): (10.0, 2 * 721 * 1440)}


def test_masks_of_files(spark, tmp_path):
    lat, lon = np.arange(-59.875, 90, 0.25), np.arange(-179.875, 180, 0.25)
    veg = np.full((1, len(lat), len(lon)), 10.0)
    veg[0, 0, 0] = np.nan
    write(tmp_path / "veg.nc", [0], lat, lon, veg, name="domveg")
    full = np.arange(89.875, -90, -0.25)  # from the north
    write(tmp_path / "reg.nc", [0], full, lon, np.broadcast_to(np.where(full > 0, 1.0, 2.0)[None, :, None], (1, 720, 1440)), name="regions")
    assert main([settings(tmp_path), "mask", f"{tmp_path}/veg.nc:domveg", f"{tmp_path}/reg.nc:regions"], spark) == 0
    got = {r.cell_id: r for r in spark.read.parquet(f"{tmp_path}/data/masks").where("cell_id % 1440 = 700").collect()}
    assert len(got) == 721 and got[100 * 1440 + 700].burnable and not got[700 * 1440 + 700].burnable
    assert got[100 * 1440 + 700].region == 1 and got[600 * 1440 + 700].region == 2
    assert json.loads(spark.read.text(f"{tmp_path}/data/region_names").first().value) == {}


def test_both_formats_are_stored_alike(spark, tmp_path):
    s, lat, lon = settings(tmp_path), np.arange(-59.875, 90, 0.25), np.arange(-179.875, 180, 0.25)
    cube = np.random.default_rng(1).integers(0, 80, (2, 721, 1440)).astype("<f4")
    cube[1, 5] = np.nan
    veg = np.random.default_rng(2).choice([10.0, 20.0], (1, len(lat), len(lon))).astype("<f4")
    full = np.arange(89.875, -90, -0.25)
    regions = np.broadcast_to(np.where(full > 0, 1, 2)[None, :, None], (1, 720, 1440)).astype("<i2")
    said = []
    for n, new, days, rows in (("classic", None, None, None), ("a", True, (1, 721, 1440), (1, 100, 1440)), ("b", False, (2, 97, 720), (1, 720, 360))):
        raw = tmp_path / n
        raw.mkdir()
        if new is None:
            write(raw / "fwi_era5_2001.nc", [0, 1], LAT, LON, cube, "days since 2001-01-01")
            write(raw / "veg.nc", [0], lat, lon, veg, name="domveg")
            write(raw / "reg.nc", [0], full, lon, regions, name="regions")
        else:
            hdf5_files.write(raw / "fwi_era5_2001.nc", [0, 1], LAT, LON, cube, "days since 2001-01-01", new=new, chunk=days)
            hdf5_files.write(raw / "veg.nc", [0], lat, lon, veg, name="domveg", new=new, chunk=rows if new else None)
            hdf5_files.write(raw / "reg.nc", [0], full, lon, regions, name="regions", new=new, chunk=rows, attrs={} if new is None else {"class_1": "North", "class_2": "South"})
        assert main([s, "ingest", "observed", str(raw)], spark) == 0
        assert main([s, "mask", f"{raw}/veg.nc:domveg", f"{raw}/reg.nc:regions"], spark) == 0
        stored = [spark.read.parquet(f"{tmp_path}/data/{t}").selectExpr("count(*)", f"bit_xor(xxhash64({c}))").first() for t, c in (("daily", "date, cell_id, fwi"), ("masks", "cell_id, burnable, region, w"))]
        said.append([tuple(r) for r in stored])
        if new is not None:
            assert json.loads(spark.read.text(f"{tmp_path}/data/region_names").first().value) == {"1": "North", "2": "South"}
    assert said[0] == said[1] == said[2] and said[0][0][0] == 2 * 721 * 1440


def test_a_file_with_foreign_days_leaves_other_years_alone(spark, tmp_path):
    s, raw = settings(tmp_path), tmp_path / "raw"
    raw.mkdir()
    slab = np.ones((3, 721, 1440))
    write(raw / "fwi_era5_2002.nc", [0, 1, 2], LAT, LON, slab, "days since 2002-01-01")
    assert main([s, "ingest", "observed", str(raw)], spark) == 0
    (raw / "fwi_era5_2002.nc").unlink()
    write(raw / "fwi_era5_2001.nc", [364, 365], LAT, LON, slab[:2], "days since 2001-01-01")
    assert main([s, "ingest", "observed", str(raw)], spark) == 1
    got = spark.read.parquet(f"{tmp_path}/data/daily").groupBy("year").agg({"date": "max", "*": "count"}).collect()
    assert [(r.year, r["count(1)"]) for r in got] == [(2002, 3 * 721 * 1440)]


def test_names_of_classes(monkeypatch):
    attrs = {"class_1": "BONA\0", "class_14": np.frombuffer(b"AUST", ">i1"), "units": "1"}
    made = SimpleNamespace(variables={"regions": SimpleNamespace(attrs=attrs, dims=["lat", "lon"])})
    monkeypatch.setattr(gridded, "grid_file", lambda path: made)
    assert gridded.class_names("a.nc", "regions") == {1: "BONA", 14: "AUST"}
