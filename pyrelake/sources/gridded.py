"""A Spark data source for yearly gridded files in the classic and in the HDF5-based NetCDF format.

spark.dataSource.register(Gridded); spark.read.format("gridded").option("year", 2001).load(folder_or_file)
Of a folder, files are read whose names the option names (a pattern) finds; all that end in .nc without it.

Rows are (date, cell_id, fwi) on the canonical grid. Files are split into blocks of days (the option days, 73), a partition
each; a block opens its file once, reads its days only, and gives Arrow batches. Blocks of chunked files begin and end
with chunks, so that no chunk is inflated twice; where a chunk has more days than a block, blocks part its rows. With the option push, and
a session that gives filters to Python sources (spark.sql.python.filterPushdown.enabled), ranges of date and cell_id leave
out blocks before any task starts, and chunks within blocks; Spark applies the filters again. load() sets the option.
Paths are folders or files of any file system that pyarrow opens
by URI, which executors must reach. Fill values are missing, packed numbers are scaled. Axes may have any usual name, order and origin. Days come
from the time axis' units, from a companion variable of day offsets, or from bare numbers 1 to 366 and the year
in the file's name.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.grid import COLUMNS, ROWS, STEP
from ..functions.names import epoch_day
from ..operators.calendar import Refused
from ..operators.listing import file_system
from ..operators.masks import SourceGrid
from .hdf5 import SIGNATURE, Hdf5
from .readers import LATITUDES, LONGITUDES, TIMES, VARIABLES

#: The format's types, by code.
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
#: What the format has for values that were never written, by type.
_FILLS = {">i2": -32767, ">i4": -2147483647, ">f4": 9.969209968386869e36, ">f8": 9.969209968386869e36}
_NAMES = {"time": TIMES, "lat": LATITUDES, "lon": LONGITUDES}


@dataclass
class Variable:
    dims: list[str]
    attrs: dict
    dtype: np.dtype
    begin: int
    record: bool
    step: int  # bytes between records
    chunk: list[int] | None = None


def opened(path: str):
    system, inner = file_system(path)
    return system.open_input_file(inner)


class Classic:
    """The header of a classic file (versions 1, 2 and 5), and slices of its variables along the first dimension."""

    def __init__(self, path: str, file=None):
        self.path, self.file = path, file or opened(path)
        self.raw = self.file.read_at(1 << 16, 0)
        while True:
            try:
                self.at = 0
                self._header()
                break
            except (struct.error, IndexError):
                more = self.file.read_at(len(self.raw), len(self.raw))
                if not more:
                    raise ValueError(f"{path}: not a classic NetCDF file") from None
                self.raw += more

    def _take(self, kind: str) -> int:
        out = struct.unpack_from(f">{kind}", self.raw, self.at)[0]
        self.at += struct.calcsize(kind)
        return out

    def _text(self) -> str:
        n = self._take(self.size)
        out = self.raw[self.at : self.at + n]
        if len(out) < n:
            raise IndexError
        self.at += -(-n // 4) * 4
        return out.decode("utf-8")

    def _count(self) -> int:
        self._take("i")
        return self._take(self.size)

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._count()):
            name, kind, n = self._text(), self._take("i"), self._take(self.size)
            dtype = np.dtype(_TYPES[kind])
            data = self.raw[self.at : self.at + n * dtype.itemsize]
            if len(data) < n * dtype.itemsize:
                raise IndexError
            out[name] = data.decode("utf-8", "replace").rstrip("\0") if kind == 2 else np.frombuffer(data, dtype)
            self.at += -(-n * dtype.itemsize // 4) * 4
        return out

    def _header(self) -> None:
        if self.raw[:3] != b"CDF" or self.raw[3] not in (1, 2, 5):
            raise ValueError(f"{self.path}: not a classic NetCDF file")
        self.at, self.size, where = 4, "q" if self.raw[3] == 5 else "i", "i" if self.raw[3] == 1 else "q"
        records = self._take(self.size)
        self.dims = [(self._text(), self._take(self.size)) for _ in range(self._count())]
        self.attrs = self._attributes()
        self.variables: dict[str, Variable] = {}
        found = []
        for _ in range(self._count()):
            name = self._text()
            ids = [self._take(self.size) for _ in range(self._take(self.size))]
            attrs, kind = self._attributes(), self._take("i")
            size, begin = self._take(self.size), self._take(where)
            record = bool(ids) and self.dims[ids[0]][1] == 0
            found.append((name, Variable([self.dims[i][0] for i in ids], attrs, np.dtype(_TYPES[kind]), begin, record, size)))
        records_size = [v.step for _, v in found if v.record]
        self.lengths = {n: s or records for n, s in self.dims}
        for name, v in found:
            inner = int(np.prod([self.lengths[d] for d in v.dims[1:]], dtype=np.int64)) * v.dtype.itemsize
            v.step = (inner if len(records_size) == 1 else sum(records_size)) if v.record else inner
            self.variables[name] = v

    def read(self, name: str, first: int = 0, last: int | None = None, rows: tuple[int, int] | None = None) -> np.ndarray:
        """A variable's places first to last, and rows of its second dimension."""
        v = self.variables[name]
        shape = [self.lengths[d] for d in v.dims]
        if not shape:
            shape, last = [1], 1
        last = shape[0] if last is None else min(last, shape[0])
        inner = int(np.prod(shape[1:], dtype=np.int64))
        if rows and len(shape) > 1:
            row, low, high = inner // max(1, shape[1]) * v.dtype.itemsize, rows[0], min(rows[1], shape[1])
            parts = [self.file.read_at((high - low) * row, v.begin + k * v.step + low * row) for k in range(first, last)]
            shape[1] = high - low
        elif v.step == inner * v.dtype.itemsize:  # the days lie one after another
            parts = [self.file.read_at((last - first) * v.step, v.begin + first * v.step)]
        else:
            parts = [self.file.read_at(inner * v.dtype.itemsize, v.begin + k * v.step) for k in range(first, last)]
        return np.frombuffer(b"".join(parts), v.dtype).reshape(last - first, *shape[1:])


GridFile = Classic | Hdf5


def grid_file(path: str) -> GridFile:
    """A file of either format, by its first bytes."""
    file = opened(path)
    return Hdf5(path, file) if file.read_at(8, 0) == SIGNATURE else Classic(path, file)


def dimension(f: GridFile, what: str) -> str:
    for n in f.lengths:
        if n.lower() in _NAMES[what]:
            return n
    raise ValueError(f"{f.path}: no {what} among {list(f.lengths)}")


def variable(f: GridFile, wanted: str | None = None) -> str:
    """The wanted or a known name, in any case; the one other variable on three dimensions only if asked for with '*'."""
    names = [wanted] if wanted and wanted != "*" else VARIABLES
    for n in names:
        for own in f.variables:
            if own.lower() == n.lower():
                return own
    cubes = [n for n, v in f.variables.items() if len(v.dims) == 3]
    if wanted == "*" and len(cubes) == 1:
        return cubes[0]
    raise ValueError(f"{f.path}: no known variable among {list(f.variables)}")


def decoded(v: Variable, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, missing) of stored numbers: fills are missing, then scale_factor and add_offset are applied."""
    fills = [x for key in ("_FillValue", "missing_value") if key in v.attrs for x in np.atleast_1d(v.attrs[key])] or [_FILLS.get(v.dtype.newbyteorder(">").str, np.nan)]
    missing = np.isin(raw, np.asarray(fills, raw.dtype))
    scale, offset = (float(np.atleast_1d(v.attrs.get(key, default))[0]) for key, default in (("scale_factor", 1.0), ("add_offset", 0.0)))
    values = raw.astype(np.float64) * scale + offset if (scale, offset) != (1.0, 0.0) else raw
    values = values.astype(np.float32)
    return values, missing | ~np.isfinite(values) | (values < 0)


def dates(f: GridFile, year: int | None) -> list[dt.date]:
    """The day of each slab; days that do not follow each other are refused only where nothing but a count tells them."""
    time = dimension(f, "time")
    axes = [v for v in ([time] if time in f.variables else [])] + [n for n, v in f.variables.items() if v.dims == [time] and n != time]
    for n in axes:
        start = epoch_day(str(f.variables[n].attrs.get("units", "")))
        if start:
            return [start + dt.timedelta(int(x)) for x in np.rint(f.read(n).astype(float))]
    year = year or named_year(f.path)
    numbers = f.read(time).astype(float) if time in f.variables else np.arange(1, f.lengths[time] + 1)
    if year is None or len(numbers) > 366 or not (np.diff(numbers) == 1).all() or numbers[0] < 1 or numbers[-1] > 366:
        raise ValueError(f"{f.path}: its time axis does not say which days it has")
    return [dt.date(year, 1, 1) + dt.timedelta(int(x) - 1) for x in numbers]


def cells(f: GridFile) -> np.ndarray:
    """The canonical cell of each (latitude, longitude) place; another resolution, or a part of the globe, is refused."""
    lat, lon = (f.read(dimension(f, w)).astype(float).ravel() for w in ("lat", "lon"))
    rows, columns = np.rint((90 - lat) / STEP), np.rint((((lon + 180) % 360) - 180 + 180) / STEP) % COLUMNS
    off = max(np.abs(90 - STEP * rows - lat).max(), np.abs(((-180 + STEP * columns - lon + 180) % 360) - 180).max())
    if off > 1e-4 or sorted(rows) != list(range(ROWS)) or sorted(columns) != list(range(COLUMNS)):
        raise ValueError(f"{f.path}: not the canonical grid of {ROWS} by {COLUMNS}")
    return (rows[:, None] * COLUMNS + columns[None, :]).astype(np.int64)


def files(path: str, names: str) -> list[str]:
    """A file itself, or the files of a folder whose names the pattern finds, in order."""
    system, inner = file_system(path)
    here = system.get_file_info(inner)
    if here.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if here.type != fs.FileType.Directory:
        return [path]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(x.base_name for x in system.get_file_info(fs.FileSelector(inner))) if re.search(names, n)]


def named_year(path: str) -> int | None:
    """The year in a file's name."""
    m = re.search(r"(?:19|20)\d{2}", os.path.basename(path))
    return int(m[0]) if m else None


def check_years(paths: list[str]) -> None:
    """Refuses files with days of another year than their name's, and two files of one year: headers and time axes are read, no data."""
    by_year = defaultdict(list)
    for path in paths:
        year = named_year(path)
        found = sorted({d.year for d in dates(grid_file(path), None)})
        if year is not None and found != [year]:
            raise Refused(f"{path}: days of {', '.join(map(str, found)) or 'no year'}, not of {year}")
        for y in found:
            by_year[y].append(path)
    for y, own in by_year.items():
        if len(own) > 1:
            raise Refused(f"{y} comes in more than one file: {', '.join(own)}")


class Block(InputPartition):
    def __init__(self, path: str, first: int, last: int, rows: tuple[int, int] | None = None):
        self.path, self.first, self.last, self.rows = path, first, last, rows


def _ranges(filters: list[Filter]) -> dict[str, tuple]:
    """The least and greatest value that filters leave of date and cell_id; None where there is no bound."""
    out = {"date": (None, None), "cell_id": (None, None)}
    one = {"date": dt.timedelta(1), "cell_id": 1}
    for f in filters:
        name = getattr(f, "attribute", (None,))[0]
        if name not in out:
            continue
        low, high = out[name]
        a = b = None
        if isinstance(f, EqualTo):
            a = b = f.value
        elif isinstance(f, In):
            values = [v for v in f.value if v is not None]
            a, b = (min(values), max(values)) if values else (None, None)
        elif isinstance(f, GreaterThan):
            a = f.value + one[name]
        elif isinstance(f, GreaterThanOrEqual):
            a = f.value
        elif isinstance(f, LessThan):
            b = f.value - one[name]
        elif isinstance(f, LessThanOrEqual):
            b = f.value
        out[name] = (a if low is None else low if a is None else max(low, a), b if high is None else high if b is None else min(high, b))
    return out


def _meets(bounds: tuple, low, high) -> bool:
    """Whether something from low to high is within bounds."""
    return (bounds[0] is None or high >= bounds[0]) and (bounds[1] is None or low <= bounds[1])


class GriddedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.days, self.variable = int(options.get("days", 73)), options.get("variable")
        self.year = int(options["year"]) if "year" in options else None
        self.names = options.get("names", r"\.nc$")
        self.ranges = _ranges([])

    def _cube(self, f: GridFile) -> tuple[str, np.ndarray, int, int]:
        """The variable, the cells of its two last dimensions, and the days and rows that are read together."""
        name = variable(f, self.variable)
        v = f.variables[name]
        order = [v.dims.index(dimension(f, w)) for w in ("time", "lat", "lon")]
        if order[0] != 0:
            raise ValueError(f"{f.path}: {name} does not begin with its time axis")
        where = cells(f) if order[1] < order[2] else cells(f).T
        return name, where, *(v.chunk[:2] if v.chunk else (1, len(where)))

    def partitions(self) -> list[Block]:
        out = []
        for path in files(self.path, self.names):
            f = grid_file(path)
            days = dates(f, self.year)
            _, where, each, rows = self._cube(f)
            step = max(1, self.days // each) * each
            # a chunk of more days than a block has its rows parted, by whole chunks
            high = max(1, -(-len(where) // rows) * self.days // each) * rows if each > self.days else len(where)
            for k in range(0, len(days), step):
                own = days[k : k + step]
                if not _meets(self.ranges["date"], min(own), max(own)):
                    continue
                for r in range(0, len(where), high):
                    some = where[r : r + high]
                    if _meets(self.ranges["cell_id"], some.min(), some.max()):
                        out.append(Block(path, k, k + len(own), (r, r + len(some))))
        return out

    def read(self, block: Block) -> Iterator[pa.RecordBatch]:
        f = grid_file(block.path)
        days = dates(f, self.year)
        name, where, each, rows = self._cube(f)
        for k in range(block.first, block.last, each):
            wanted = [t for t in range(k, min(k + each, block.last)) if _meets(self.ranges["date"], days[t], days[t])]
            for r in range(block.rows[0], block.rows[1], rows) if wanted else ():
                own = where[r : min(r + rows, block.rows[1])]
                if not _meets(self.ranges["cell_id"], own.min(), own.max()):
                    continue
                cube = f.read(name, wanted[0], wanted[-1] + 1, (r, r + len(own)))
                for t in wanted:
                    slab, missing = (x.ravel() for x in decoded(f.variables[name], cube[t - wanted[0]]))
                    yield pa.RecordBatch.from_arrays([pa.array([days[t]] * len(slab), pa.date32()), pa.array(own.ravel()), pa.array(slab, mask=missing)], ["date", "cell_id", "fwi"])


class PushedReader(GriddedReader):
    """With filters, which Spark gives only where the session allows it and then asks of every reader that takes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.ranges = _ranges(filters)
        yield from filters  # blocks are left out by them, rows are not


class Gridded(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gridded"

    def schema(self) -> str:
        return "date date, cell_id bigint, fwi float"

    def reader(self, schema) -> GriddedReader:
        return (PushedReader if self.options.get("push", "false").lower() == "true" else GriddedReader)(self.options)


def load(spark: SparkSession, path: str, **options) -> DataFrame:
    """The days of a file or folder, with filters pushed into the source where the session allows it."""
    spark.dataSource.register(Gridded)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("gridded").options(push=push, **options).load(path)


class Rows(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class LayerReader(DataSourceReader):
    """One variable on latitude and longitude, of a time axis the first place; a partition is a block of latitudes."""

    def __init__(self, options: dict, block: int = 128):
        self.path, self.variable, self.block = options["path"], options["variable"], block

    def partitions(self) -> list[Rows]:
        f = grid_file(self.path)
        n = f.lengths[dimension(f, "lat")]
        return [Rows(k, min(k + self.block, n)) for k in range(0, n, self.block)]

    def read(self, rows: Rows) -> Iterator[pa.RecordBatch]:
        f = grid_file(self.path)
        name, (lat, lon) = variable(f, self.variable), axes_of(f)
        v, axes = f.variables[name], [dimension(f, w) for w in ("lat", "lon")]
        up, east = np.argsort(lat), np.argsort(lon)
        own = up[rows.first : rows.last]
        low, high = int(own.min()), int(own.max()) + 1
        if v.dims[0] == axes[0]:
            stored = f.read(name, low, high)
        elif v.dims[0] in axes:
            stored = f.read(name)[:, low:high]
        else:
            stored = f.read(name, 0, 1, (low, high) if v.dims[1] == axes[0] else None)
            if v.dims[1] != axes[0]:
                stored = stored[:, :, low:high]
        order = [v.dims.index(d) for d in axes]
        plane = np.transpose(stored, [k for k in range(stored.ndim) if k not in order] + order).reshape(-1, high - low, len(lon))[0]
        values, missing = decoded(v, plane[own - low][:, east])
        i, j = (x.ravel() for x in np.indices(values.shape))
        yield pa.RecordBatch.from_arrays([pa.array((i + rows.first).astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(lat[up][i + rows.first]), pa.array(lon[east][j]), pa.array(values.ravel(), mask=missing.ravel())], ["lat_idx", "lon_idx", "lat", "lon", "code"])


class Layer(DataSource):
    """spark.read.format("gridded_layer").option("variable", name).load(file): places count from the south and from the west."""

    @classmethod
    def name(cls) -> str:
        return "gridded_layer"

    def schema(self) -> str:
        return "lat_idx int, lon_idx int, lat double, lon double, code float"

    def reader(self, schema) -> LayerReader:
        return LayerReader(self.options)


def axes_of(f: GridFile) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and longitudes, these from -180 to below 180."""
    lat, lon = (f.read(dimension(f, w)).astype(float).ravel() for w in ("lat", "lon"))
    return lat, (lon + 180) % 360 - 180


def source_grid(path: str) -> SourceGrid:
    """The grid of a layer, by its own axes; unevenly spaced ones are refused."""
    lat, lon = (np.sort(x) for x in axes_of(grid_file(path)))
    steps = np.concatenate([np.diff(lat), np.diff(lon)])
    if not len(steps) or np.ptp(steps) > 1e-4 or steps.min() <= 0:
        raise ValueError(f"{path}: latitudes and longitudes are not evenly spaced")
    return SourceGrid(lat[0], len(lat), lon[0], len(lon), round(float(steps.mean()), 6))


def class_names(path: str, name: str) -> dict[int, str]:
    """The names of a variable's classes, from its attributes class_0, class_1 and so on."""
    f = grid_file(path)
    attrs = f.variables[variable(f, name)].attrs
    text = lambda v: (v if isinstance(v, str) else bytes(v).decode("utf-8", "replace")).rstrip("\0")
    return {int(m[1]): text(v) for k, v in attrs.items() if (m := re.fullmatch(r"class_(\d+)", k))}
