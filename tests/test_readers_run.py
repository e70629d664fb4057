"""Readers' checks, and the whole way from stored days to a bundle."""

import datetime as dt
import json

import pytest
from pyrelake.__main__ import main
from pyrelake.config import load
from pyrelake.operators import calendar, packing
from pyrelake.operators.calendar import Refused
from pyrelake.sources import bundle, readers
from pyrelake.sources.layout import Layout


def test_points_of_other_layouts_find_their_cells(spark):
    rows = [(-90.0, 0.0, 1.0), (90.0, 359.75, -3e38), (89.75, 180.0, 2.0)]
    df = spark.createDataFrame(rows, "Latitude double, LONGITUDE double, FWI float")
    got = {r.cell_id: r.fwi for r in readers.check_canonical(readers.canonical(df)).collect()}
    assert got == {720 * 1440 + 720: 1.0, 719: None, 1440: 2.0}


def test_refusals(spark):
    with pytest.raises(Refused):
        readers.check_canonical(readers.canonical(spark.createDataFrame([(0.1, 0.0, 1.0)], "lat double, lon double, fwi float")))
    with pytest.raises(ValueError, match="variable"):
        readers.canonical(spark.createDataFrame([(0.0, 0.0, 1.0)], "lat double, lon double, other float"))
    assert readers.canonical(spark.createDataFrame([(0.0, 0.0, 1.0)], "lat double, lon double, other float"), True).first().fwi == 1.0
    with pytest.raises(ValueError, match="latitude"):
        readers.canonical(spark.createDataFrame([(1.0,)], "fwi float"))
    slabs = spark.createDataFrame([(dt.date(2021, 1, 1), 1), (dt.date(2021, 1, 1), 2), (dt.date(2021, 1, 2), 1)], "date date, cell_id long")
    assert [tuple(r) for r in readers.incomplete_slabs(slabs, 2).collect()] == [(dt.date(2021, 1, 2), 1)]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("run")
    days = [dt.date(2000, 1, 1) + dt.timedelta(i) for i in range(366 + 365)]
    rows = [(w, d.year, d, c, float(10 * c + d.timetuple().tm_yday % 7 + (w == "observed"))) for w in ("observed", "counterfactual") for d in days for c in (1, 2, 3)]
    spark.createDataFrame(rows, readers.DAILY).write.partitionBy("world", "year").parquet(f"{path}/daily")
    spark.createDataFrame([(1, True, 1, 1.0), (2, True, 2, 0.5), (3, False, 2, 1.0)], readers.MASKS).write.parquet(f"{path}/masks")
    (path / "s.toml").write_text(f'[paths]\nroot = "{path}"\n[archive]\nfirst_year = 2000\nlast_year = 2001\n[reference]\nfirst_year = 2000\nlast_year = 2001\nquantiles = [0.9, 0.99]\n[histogram]\nfine_max = 80\nfine_step = 0.2\ncoarse_max = 300\ncoarse_step = 1\nvalidation_cells = 10\nseed = 1\n[mask]\nburnable_classes = [1]\nvote_threshold = 0.5\n')
    return path


def test_all_passes(spark, root, capsys):
    s = str(root / "s.toml")
    assert main([s, "monthly", "observed", "2000-2001"], spark) == 2  # no thresholds yet
    assert main([s, "thresholds"], spark) == 0
    thr = {(r.cell_id, r.threshold): r for r in spark.read.parquet(f"{root}/thresholds_2000_2001").collect()}
    assert len(thr) == 6 and thr[1, "p90"].n_samples == 731 and 16 < thr[1, "p90"].thr <= 17.2
    assert json.loads(spark.read.text(f"{root}/thresholds_2000_2001.provenance").first().value)["n_days"] == 731
    for _ in range(2):  # a year that is run again replaces itself
        assert main([s, "monthly", "observed", "2000-2001", "--regions", "1,2,14"], spark) == 0
    assert main([s, "monthly", "counterfactual", "2000-2001", "--regions", "1,2,14"], spark) == 0
    monthly = spark.read.parquet(f"{root}/monthly")
    assert monthly.count() == 2 * 24 * 3 * 2
    extent = spark.read.parquet(f"{root}/extent")
    assert extent.columns[:4] == ["date", "threshold", "global", "coverage"] and extent.count() == 2 * 731 * 2
    assert extent.where("region_14 IS NOT NULL").count() == 0 and extent.where("coverage <> 1").count() == 0
    capsys.readouterr()
    assert main([s, "pack", "observed"], spark) == 0
    made = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert made["worlds"]["observed"]["extent"]["n_days"] == 731 and made["worlds"]["observed"]["thresholds"]["p90"][0]["n_frames"] == 24
    index = spark.read.parquet(f"{root}/bundle/cells")
    back = packing.unpack_frames(spark.read.parquet(f"{root}/bundle/frames"), index)
    want = monthly.where("world = 'observed'").join(index, "cell_id").groupBy("threshold").sum("days").collect()
    assert {r.threshold: r[1] for r in back.groupBy("threshold").sum("days").collect()} == {r.threshold: r[1] for r in want}
    # the same as files in a client's form, beside those of the other world
    assert main([s, "pack", "counterfactual", "--chunk-years", "1", "--quality", "5"], spark) == 0
    folder = str(root / "web")
    assert main([s, "export", folder, "--worlds", "observed"], spark) == 0 and main([s, "export", folder], spark) == 0
    m = bundle.read_manifest(folder)
    assert [len(m["worlds"][w]["thresholds"]["p90"]) for w in ("observed", "counterfactual")] == [1, 2]
    assert m["worlds"]["observed"]["days_observed"] == [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    assert m["worlds"]["observed"]["extent"]["shape"] == [731, 2, 8] and json.loads((root / "web" / "grid.json").read_text())["n_cells"] == 2
    files = bundle.frames(spark, folder).where("world = 'observed'").groupBy("threshold").sum("days").collect()
    assert {r.threshold: r[1] for r in files} == {r.threshold: r[1] for r in want}
    # laid out by cell, the passes give the same
    before = sorted(map(tuple, monthly.collect()))
    assert main([s, "arrange", "observed", "--buckets", "2"], spark) == 0
    assert main([s, "thresholds", "2000-2000", ], spark) == 0 and main([s, "monthly", "observed", "2000-2001", "--regions", "1,2,14", "--thresholds", "2000-2001"], spark) == 0
    spark.catalog.clearCache()
    assert sorted(map(tuple, spark.read.parquet(f"{root}/monthly").collect())) == before
    layout, settings = Layout(str(root)), load(s)
    assert layout.stored_thresholds(spark, settings).endswith("2000_2001") and layout.stored_thresholds(spark, settings.of_years((1999,))).endswith("thresholds_2000_2001")
    # another mask under a packed bundle is refused
    spark.createDataFrame([(1, True, 1, 1.0), (2, False, 2, 0.5), (3, True, 2, 1.0)], readers.MASKS).write.mode("overwrite").parquet(f"{root}/masks")
    assert main([s, "pack", "observed"], spark) == 1
    assert main([s, "pack", "observed", "--force"], spark) == 0
    spark.catalog.clearCache()


def test_years_that_are_not_whole_are_not_packed(spark):
    cells = spark.createDataFrame([(1, True), (2, True), (3, False)], "cell_id long, burnable boolean")
    rows = [("observed", y, m, c, t, 1) for y in (2001, 2002, 2003) for m in range(1, 13) for c in (1, 2, 3) for t in ("p90", "p95") if (y, m, c) != (2002, 3, 2) and (y, m) != (2003, 12)]
    counts = spark.createDataFrame(rows, "world string, year int, month int, cell_id long, threshold string, days long")
    assert sorted((r.year, r.months, r["rows"]) for r in packing.unfinished_years(counts, cells, ["p90", "p95"]).collect()) == [(2002, 24, 46), (2003, 22, 44)]


def test_days_of_another_year_are_seen_in_the_same_sums(spark, root, tmp_path):
    from pyrelake.plans.run import check_days

    rows = [("observed", 2000, dt.date(2001, 1, 1), 1, 1.0), ("observed", 2000, dt.date(2000, 1, 1), 1, 1.0)]
    daily = spark.createDataFrame(rows, readers.DAILY)
    with pytest.raises(Refused, match="another year"):
        check_days(daily, calendar.cell_months(daily), True)


def test_verify(spark, root, tmp_path, capsys):
    import hashlib

    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.nc").write_bytes(b"abc")
    files = [{"path": p, "size": 3, "digestType": "sha-256", "digest": hashlib.sha256(b"abc").hexdigest().upper()} for p in ("a.nc", "b.nc")]
    (tmp_path / "list.json").write_text(json.dumps({"_embedded": {"stash:files": files}}, indent=1))
    args = [str(root / "s.toml"), "verify", str(tmp_path / "list.json"), str(folder)]
    assert main(args, spark) == 0 and capsys.readouterr().out.strip() == "missing: 1, verified: 1"
    (folder / "b.nc").write_bytes(b"abd")
    assert main(args, spark) == 3
    (folder / "a.nc").unlink()
    (folder / "b.nc").rename(folder / "c.nc")
    assert main(args, spark) == 2


def test_exit_codes(spark, root, capsys):
    s = str(root / "s.toml")
    assert main([s, "monthly", "observed", "1990"], spark) == 2
    assert main([s, "monthly", "observed", "2001-2000"], spark) == 1
