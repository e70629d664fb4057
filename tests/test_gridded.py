import datetime as dt
import struct

import hdf5_files
import numpy as np
import pytest
from pyrelake.operators.calendar import Refused
from pyrelake.sources import gridded
from pyrelake.sources.gridded import Classic, Gridded, Variable, cells, dates, decoded, grid_file, variable
from pyrelake.sources.hdf5 import Unsupported
from pyrelake.functions.names import epoch_day as epoch


def write(path, times, lat, lon, cube, units=None, name="fwi", names=("time", "lat", "lon"), record=False, extra=None):
    """A small classic file, version 2."""
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    text = lambda s: struct.pack(">i", len(s)) + pad(s.encode())
    dims = [(names[0], len(times)), (names[1], len(lat)), (names[2], len(lon))]
    attrs = (struct.pack(">ii", 12, 1) + text("units") + struct.pack(">ii", 2, len(units)) + pad(units.encode())) if units else struct.pack(">ii", 0, 0)
    variables = [(names[0], [0], attrs, np.array(times, ">f8")), (names[1], [1], struct.pack(">ii", 0, 0), np.array(lat, ">f8")), (names[2], [2], struct.pack(">ii", 0, 0), np.array(lon, ">f8")), (name, [0, 1, 2], struct.pack(">ii", 0, 0), cube.astype(">f4"))]
    head = b"CDF\x02" + struct.pack(">i", len(times) if record else 0) + struct.pack(">ii", 10, 3) + b"".join(text(n) + struct.pack(">i", 0 if record and k == 0 else s) for k, (n, s) in enumerate(dims)) + struct.pack(">ii", 0, 0) + struct.pack(">ii", 11, len(variables))
    size = len(head) + sum(len(text(n)) + 4 + 4 * len(i) + len(a) + 4 + 4 + 8 for n, i, a, _ in variables)
    at, body, entries = size, [], []
    kinds = {">f8": 6, ">f4": 5}
    in_records = [v for v in variables if record and v[1][0] == 0]
    fixed = [v for v in variables if v not in in_records]
    where = {}
    for v in fixed:
        where[v[0]] = at
        body.append(v[3].tobytes())
        at += v[3].nbytes
    for v in in_records:
        where[v[0]] = at
        at += v[3][0].nbytes
    for k in range(len(times) if record else 0):
        body += [v[3][k : k + 1].tobytes() for v in in_records]
    for n, ids, a, data in variables:
        one = data[0].nbytes if record and ids[0] == 0 else data.nbytes
        entries.append(text(n) + struct.pack(">i", len(ids)) + struct.pack(f">{len(ids)}i", *ids) + a + struct.pack(">iiq", kinds[data.dtype.str], one, where[n]))
    path.write_bytes(head + b"".join(entries) + b"".join(body))


LAT, LON = 90 - 0.25 * np.arange(721), -180 + 0.25 * np.arange(1440)


def test_small_headers_and_slices(tmp_path):
    cube = np.arange(3 * 2 * 4).reshape(3, 2, 4).astype(float)
    for record in (False, True):
        write(tmp_path / "a.nc", [0, 1, 2], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0], cube, "days since 2000-02-28", record=record)
        f = Classic(str(tmp_path / "a.nc"))
        assert (f.read("fwi") == cube).all() and (f.read("fwi", 1, 2) == cube[1:2]).all()
        assert dates(f, None) == [dt.date(2000, 2, 28), dt.date(2000, 2, 29), dt.date(2000, 3, 1)]
        with pytest.raises(ValueError, match="canonical"):
            cells(f)
    (tmp_path / "b.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + b"\0" * 100)
    with pytest.raises(ValueError, match="classic"):
        Classic(str(tmp_path / "b.nc"))


def test_time_axes_and_names(tmp_path):
    cube = np.zeros((3, 1, 1))
    write(tmp_path / "x_2004.nc", [1, 2, 3], [0.0], [0.0], cube, name="other", names=("Time", "Latitude", "Longitude"))
    f = Classic(str(tmp_path / "x_2004.nc"))
    assert dates(f, None)[0] == dt.date(2004, 1, 1) and dates(f, 2010)[2] == dt.date(2010, 1, 3)
    with pytest.raises(ValueError, match="known variable"):
        variable(f)
    assert variable(f, "*") == "other"
    write(tmp_path / "x_2004.nc", [1, 2, 9], [0.0], [0.0], cube)
    with pytest.raises(ValueError, match="time axis"):
        dates(Classic(str(tmp_path / "x_2004.nc")), None)
    assert epoch("days_since_Jan11900") == dt.date(1900, 1, 1) and epoch("hours since 1900-01-01") is None and epoch("day since 1979-1-2") == dt.date(1979, 1, 2)


def test_fills_and_packed_numbers():
    def of(dtype, **attrs):
        return Variable(["time", "lat", "lon"], {k: np.array([v]) for k, v in attrs.items()}, np.dtype(dtype), 0, False, 0)

    values, missing = decoded(of(">f4"), np.array([1.5, 9.969209968386869e36, np.nan, -1.0], ">f4"))
    assert missing.tolist() == [False, True, True, True] and values[0] == 1.5
    values, missing = decoded(of(">i2", _FillValue=-5, scale_factor=0.5, add_offset=10.0), np.array([-5, 4, -20], ">i2"))
    assert missing.tolist() == [True, False, False] and values[1:].tolist() == [12.0, 0.0]
    values, missing = decoded(of(">f8", missing_value=7.0), np.array([7.0, 8.0], ">f8"))
    assert missing.tolist() == [True, False]


def test_a_year_on_another_layout(spark, tmp_path):
    lat, lon = LAT[::-1], np.where(LON < 0, LON + 360, LON)
    lon = np.sort(lon)
    signed = np.where(lon >= 180, lon - 360, lon)
    slab = lat[:, None] * 1000 + signed[None, :]
    cube = np.stack([slab, slab + 1])
    cube[:, 5, 7] = -3.4e38
    write(tmp_path / "fwi_1999.nc", [0, 1], lat, lon, cube, "days since 1999-01-01")
    spark.dataSource.register(Gridded)
    df = spark.read.format("gridded").option("days", 1).load(str(tmp_path / "fwi_1999.nc"))
    assert df.rdd.getNumPartitions() == 2
    top = {(r.date, r.cell_id): r.fwi for r in df.where("cell_id IN (0, 721, 1440)").collect()}
    assert top[dt.date(1999, 1, 2), 0] == 90 * 1000 - 180 + 1 and top[dt.date(1999, 1, 1), 721] == pytest.approx(90 * 1000 + 0.25)
    assert df.where("fwi IS NULL").count() > 2 and df.count() == 2 * 721 * 1440


@pytest.mark.parametrize("new", [True, False])
@pytest.mark.parametrize("how", [{}, {"chunk": (2, 3, 4)}, {"chunk": (1, 5, 7), "shuffle": False, "checksum": True}, {"chunk": (4, 2, 3), "deflate": False}])
def test_hdf5_based_files(tmp_path, new, how):
    cube = np.arange(5 * 5 * 7).reshape(5, 5, 7).astype(">f4" if new else "<f4")
    hdf5_files.write(tmp_path / "a.nc", range(5), np.arange(5.0), np.arange(7.0), cube, "days since 2000-02-28", new=new, attrs={"_FillValue": np.float32(-5), "long_name": "x" * 30}, **how)
    f = grid_file(str(tmp_path / "a.nc"))
    v = f.variables["fwi"]
    assert v.dims == ["time", "lat", "lon"] and v.attrs["_FillValue"] == [-5] and v.attrs["long_name"] == "x" * 30
    assert f.lengths == {"time": 5, "lat": 5, "lon": 7} and v.chunk == (list(how["chunk"]) if how else None)
    assert (f.read("fwi") == cube).all() and (f.read("lat") == np.arange(5.0)).all()
    assert (f.read("fwi", 1, 4, (2, 5)) == cube[1:4, 2:5]).all() and (f.read("fwi", 3) == cube[3:]).all()
    assert dates(f, None)[-1] == dt.date(2000, 3, 3)


@pytest.mark.parametrize("n", [2, 9, 40])
def test_many_attributes_and_links(tmp_path, n):
    """They are in heaps of their own; few of them fit a node of the tree, so that it has two levels."""
    cube = np.ones((2, 2, 3), "<f4")
    attrs = {f"note_{k}": f"{k} " * (k + 1) for k in range(n)} | {"_FillValue": np.float32(-7)}
    hdf5_files.write(tmp_path / "a.nc", [0, 1], [0.0, 1.0], [0.0, 1.0, 2.0], cube, "days since 2001-01-01", attrs=attrs, dense=2, chunk=(1, 2, 3))
    f = grid_file(str(tmp_path / "a.nc"))
    v = f.variables["fwi"]
    assert v.dims == ["time", "lat", "lon"] and {k: v.attrs[k] for k in attrs if k != "_FillValue"} == {k: x for k, x in attrs.items() if k != "_FillValue"} and v.attrs["_FillValue"] == [-7]
    assert (f.read("fwi") == cube).all() and dates(f, None) == [dt.date(2001, 1, 1), dt.date(2001, 1, 2)]


def test_chunks_that_were_never_written_and_what_is_not_read(tmp_path):
    cube = np.ones((4, 2, 2), "<f4")
    hdf5_files.write(tmp_path / "a.nc", range(4), [0.0, 1.0], [0.0, 1.0], cube, chunk=(1, 2, 2), absent={(2, 0, 0)})
    f = grid_file(str(tmp_path / "a.nc"))
    assert [x.tolist() for x in f.read("fwi")[:, 0, 0]] == [1, 1, -99, 1] and f.variables["fwi"].dims == ["time", "of_2", "of_2"] or f.variables["fwi"].dims[0] == "time"
    raw = (tmp_path / "a.nc").read_bytes()
    (tmp_path / "b.nc").write_bytes(raw[: len(raw) // 2])
    with pytest.raises(ValueError, match="ends at byte"):
        grid_file(str(tmp_path / "b.nc"))
    (tmp_path / "c.nc").write_bytes(raw.replace(struct.pack("<HHHI", 1, 0, 1, 4), struct.pack("<HHHI", 7, 0, 1, 4)))
    with pytest.raises(Unsupported, match="filter 7"):
        grid_file(str(tmp_path / "c.nc"))


@pytest.fixture(scope="module")
def year_files(tmp_path_factory):
    """The same days in both formats, chunked by days and by rows."""
    path = tmp_path_factory.mktemp("years")
    slab = np.round(LAT[:, None] + LON[None, :] / 4, 2).astype("<f4")
    cube = np.stack([slab + k for k in range(6)])
    args = ([0, 1, 2, 3, 4, 5], LAT, LON, cube, "days since 2001-01-01")
    for n in ("classic", "days", "rows"):
        (path / n).mkdir()
    write(path / "classic" / "fwi_2001.nc", *args)
    hdf5_files.write(path / "days" / "fwi_2001.nc", *args, chunk=(2, 721, 1440))
    hdf5_files.write(path / "rows" / "fwi_2001.nc", *args, new=False, chunk=(6, 100, 1440))
    return path


def test_both_formats_give_the_same_rows(spark, year_files):
    of = {n: gridded.load(spark, str(year_files / n), days=2) for n in ("classic", "days", "rows")}
    assert [of[n].rdd.getNumPartitions() for n in of] == [3, 3, 4]
    sums = {n: tuple(df.selectExpr("count(*)", "count(fwi)", "bit_xor(xxhash64(date, cell_id, fwi))").first()) for n, df in of.items()}
    assert len(set(sums.values())) == 1 and sums["classic"][0] == 6 * 721 * 1440


def test_ranges_of_days_and_cells_leave_out_blocks(spark, year_files):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for n, parts in (("classic", (2, 1)), ("days", (2, 1)), ("rows", (4, 1))):
            df = gridded.load(spark, str(year_files / n), days=2)
            some = df.where("date >= '2001-01-02' AND date < '2001-01-04'")
            assert some.rdd.getNumPartitions() == parts[0] and some.count() == 2 * 721 * 1440
            few = df.where("date = '2001-01-05' AND cell_id BETWEEN 1440 * 150 AND 1440 * 160 - 1")
            assert few.rdd.getNumPartitions() == parts[1] and few.count() == 10 * 1440
            either = df.where("date IN ('2001-01-01', '2001-01-06') AND fwi > 0 AND cell_id <> 3")
            spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
            whole = gridded.load(spark, str(year_files / n), days=2).where("day(date) IN (1, 6) AND fwi > 0 AND cell_id <> 3")
            spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
            assert either.count() == whole.count() > 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_ranges_by_themselves():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

    day = dt.date(2001, 1, 5)
    assert gridded._ranges([GreaterThan(("date",), day), LessThanOrEqual(("cell_id",), 7), IsNotNull(("date",)), In(("cell_id",), (3, None, 9))]) == {"date": (day + dt.timedelta(1), None), "cell_id": (3, 7)}
    assert gridded._ranges([EqualTo(("fwi",), 1.0)]) == {"date": (None, None), "cell_id": (None, None)}


def test_files_with_foreign_days_are_refused(tmp_path):
    cube = np.zeros((2, 1, 1))
    write(tmp_path / "fwi_2001.nc", [364, 365], [0.0], [0.0], cube, "days since 2001-01-01")
    with pytest.raises(Refused, match="2002"):
        gridded.check_years([str(tmp_path / "fwi_2001.nc")])
    write(tmp_path / "a_2001.nc", [0, 1], [0.0], [0.0], cube, "days since 2001-01-01")
    gridded.check_years([str(tmp_path / "a_2001.nc")])
    with pytest.raises(Refused, match="more than one"):
        gridded.check_years([str(tmp_path / "a_2001.nc")] * 2)
