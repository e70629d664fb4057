"""Packed bundles: positional frames of small numbers, compressed, and what a client looks up in them.

A bundle has the cells' order, one block of frames a threshold and stretch of years (a byte a cell and
month, month by month), and a cube of daily extents (two bytes a day, threshold and column). Blocks are rows
of a DataFrame with a BINARY column: each is made in one task from a bounded number of frames.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import SCALE, packed
from .calendar import missing_years, refuse

QUALITY = 9


def compress(data: bytes, quality: int = QUALITY) -> bytes:
    return pa.Codec("brotli", compression_level=quality).compress(data, asbytes=True)


def expand(blob: bytes, size: int) -> bytes:
    """The size is known from the frames and cells; a blob of another is refused."""
    out = pa.Codec("brotli").decompress(blob, decompressed_size=size, asbytes=True)
    if len(out) != size:
        raise ValueError(f"a block of {len(out)} bytes, not {size}")
    return out


def cell_index(cells: DataFrame) -> DataFrame:
    """(cell_id, pos) of burnable cells in the grid's order, from 0. The grid bounds how many there are."""
    return cells.where("burnable").select("cell_id", (F.row_number().over(Window.orderBy("cell_id")) - 1).cast("long").alias("pos"))


def index_digest(index: DataFrame) -> str:
    """What tells a changed index, also one of the same length."""
    return index.agg(F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("pos", "cell_id"))), lambda x: x["cell_id"].cast("string"))), 256)).first()[0]


def chunk_of(year, first_year, years_each: int):
    return F.floor((year - first_year) / years_each).cast("int")


def frame_chunks(years: DataFrame, years_each: int) -> DataFrame:
    """(chunk, first_year, n_frames) of consecutive years (year); years with a gap are refused."""
    refuse(missing_years(years), "years are missing before packing")
    first = years.agg(F.min("year").alias("first"))
    return years.crossJoin(F.broadcast(first)).groupBy(chunk_of(F.col("year"), F.col("first"), years_each).alias("chunk")).agg(F.min("year").alias("first_year"), (F.count("*") * 12).alias("n_frames"))  # one row


def pack_frames(counts: DataFrame, index: DataFrame, first_year: int, years_each: int = 10, quality: int = QUALITY) -> DataFrame:
    """(world, threshold, chunk, first_year, n_frames, n_cells, blob) of counts (world, year, month, cell_id, threshold, days).

    Cells outside the index are left out, cells and months without a row are zeros; a frame that no year of a chunk
    reaches is not there. days must fit a byte.
    """
    n_cells = index.count()
    placed = counts.join(index, "cell_id").select("world", "threshold", "year", "month", "pos", "days")

    def frame(key: tuple, table: pa.Table) -> pa.Table:
        days = table["days"].to_numpy()
        if len(days) and (days.min() < 0 or days.max() > 255):
            raise ValueError("days do not fit a byte")
        row = np.zeros(n_cells, np.uint8)
        row[table["pos"].to_numpy()] = days
        return pa.table({**{n: pa.array([k.as_py()], t) for n, k, t in zip(("world", "threshold", "year", "month"), key, (pa.string(), pa.string(), pa.int32(), pa.int32()), strict=True)}, "frame": [row.tobytes()]})

    def pack(key, rows):
        world, threshold, chunk = key
        start = first_year + chunk * years_each
        frames = np.zeros(((int(rows["year"].max()) - start + 1) * 12, n_cells), np.uint8)
        for at, data in zip((rows["year"] - start) * 12 + rows["month"] - 1, rows["frame"], strict=True):
            frames[at] = np.frombuffer(data, np.uint8)
        return pd.DataFrame({"world": [world], "threshold": [threshold], "chunk": [chunk], "first_year": [start], "n_frames": [len(frames)], "n_cells": [n_cells], "blob": [compress(frames.tobytes(), quality)]})

    # first a month's bytes, of a row a cell at most and numbers alone; then a chunk's frames, twelve a year
    frames = placed.groupBy("world", "threshold", "year", "month").applyInArrow(frame, "world string, threshold string, year int, month int, frame binary")
    chunked = frames.withColumn("chunk", chunk_of(F.col("year"), F.lit(first_year), years_each))
    return chunked.groupBy("world", "threshold", "chunk").applyInPandas(pack, "world string, threshold string, chunk int, first_year int, n_frames int, n_cells long, blob binary")


def unpack_frames(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """(world, threshold, year, month, cell_id, days): every frame of the blocks, a row a cell of the index. A month is given out at a time."""

    def unpack(batches):
        for batch in batches:
            for r in batch.itertuples():
                frames = np.frombuffer(expand(r.blob, r.n_frames * r.n_cells), np.uint8).reshape(r.n_frames, r.n_cells)
                for k, days in enumerate(frames):
                    yield pd.DataFrame({"world": r.world, "threshold": r.threshold, "year": r.first_year + k // 12, "month": k % 12 + 1, "pos": np.arange(r.n_cells), "days": days.astype(np.int64)})

    frames = blocks.mapInPandas(unpack, "world string, threshold string, year int, month int, pos long, days long")
    return frames.join(index, "pos").select("world", "threshold", "year", "month", "cell_id", "days")


def raw_sizes(blocks: DataFrame) -> DataFrame:
    """blocks with raw_bytes, what their blobs hold, and packed_bytes, what they take."""

    @F.pandas_udf("long")
    def size(blobs: pd.Series, expected: pd.Series) -> pd.Series:
        return pd.Series([len(expand(b, int(n))) for b, n in zip(blobs, expected, strict=True)])

    return blocks.withColumns({"raw_bytes": size("blob", F.col("n_frames") * F.col("n_cells")), "packed_bytes": F.length("blob")})


def unfinished_years(counts: DataFrame, cells: DataFrame, thresholds: list[str]) -> DataFrame:
    """(world, year, months, rows) of years that do not have twelve months of every threshold, or not one count of each burnable cell in each."""
    burnable = cells.where("burnable").select("cell_id")
    placed = counts.join(burnable, "cell_id", "left_semi").where(F.col("threshold").isin(*thresholds))
    found = placed.groupBy("world", "year", "month", "threshold").agg(F.count("*").alias("rows")).groupBy("world", "year").agg(F.count("*").alias("months"), F.sum("rows").alias("rows"))
    whole = F.lit(12 * len(thresholds))
    return found.join(F.broadcast(burnable.agg(F.count("*").alias("of"))), (F.col("months") != whole) | (F.col("rows") != whole * F.col("of"))).select("world", "year", "months", "rows")  # one row


def scattered(frame: DataFrame, grid: DataFrame) -> DataFrame:
    """A frame (cell_id, days) over the whole grid (cell_id), zeros outside; texel is days + 1 inside and 0 outside."""
    return grid.select("cell_id").join(frame.select("cell_id", "days"), "cell_id", "left").select("cell_id", F.coalesce("days", F.lit(0)).alias("days"), F.coalesce(F.col("days") + 1, F.lit(0)).alias("texel"))


def frame_at(blocks: DataFrame, world: str, threshold: str, month_idx: int) -> DataFrame:
    """(world, threshold, month_idx, frame BINARY): one month's bytes out of its block; no row where there is no such month."""
    first = blocks.select(F.min("first_year").alias("origin"))
    mine = blocks.where((F.col("world") == world) & (F.col("threshold") == threshold)).crossJoin(F.broadcast(first))  # one row
    mine = mine.withColumn("at", F.lit(month_idx) - (F.col("first_year") - F.col("origin")) * 12).where("at >= 0 AND at < n_frames")

    def cut(batches):
        for batch in batches:
            for r in batch.itertuples():
                data = expand(r.blob, r.n_frames * r.n_cells)
                yield pd.DataFrame({"world": [world], "threshold": [threshold], "month_idx": [month_idx], "frame": [data[r.at * r.n_cells : (r.at + 1) * r.n_cells]]})

    return mine.select("first_year", "n_frames", "n_cells", "blob", "at").mapInPandas(cut, "world string, threshold string, month_idx int, frame binary")


def day_offsets(dates: DataFrame) -> DataFrame:
    """(date, day_offset) from the first date."""
    first = dates.agg(F.min("date").alias("first"))
    return dates.crossJoin(F.broadcast(first)).select("date", F.datediff("date", "first").alias("day_offset"))  # one row


def quantised(extent: DataFrame, columns: list[str]) -> DataFrame:
    """extent with its columns as whole numbers of ten thousandths."""
    return extent.select(*[c for c in extent.columns if c not in columns], *[packed(F.col(c)).alias(c) for c in columns])


def uneven_thresholds(extent: DataFrame) -> DataFrame:
    """(threshold, n) of thresholds that do not have the days that others have."""
    counts = extent.groupBy("threshold").agg(F.countDistinct("date").alias("n"))
    return counts.join(F.broadcast(extent.agg(F.countDistinct("date").alias("all_days"))), F.col("n") != F.col("all_days")).select("threshold", "n")  # one row


def pack_extent(extent: DataFrame, columns: list[str], thresholds: list[str], quality: int = QUALITY, reindex: bool = False) -> DataFrame:
    """(world, first_date, n_days, gaps, offsets BINARY, cube BINARY, valid BINARY) of wide daily extents, one row a world.

    A world whose thresholds do not have the same days is refused, unless they are to be brought onto one axis of all of its days: then days that a threshold lacks are
    zeros, and valid has a bit a day and threshold that is there. The cube is days x thresholds x columns of u16, the offsets are i32 days from the first: all of a world's
    days are one small table (thousands of rows).
    """
    def pack(rows):
        days = np.sort(rows["date"].unique())
        if rows.duplicated(["date", "threshold"]).any():
            raise ValueError(f"{rows['world'].iloc[0]}: days that come twice")
        if not reindex and not (rows.groupby("threshold")["date"].nunique().reindex(thresholds, fill_value=0) == len(days)).all():
            raise ValueError(f"{rows['world'].iloc[0]}: thresholds with other days")
        offsets = np.array([(d - days[0]).days for d in days], "<i4")
        cube, valid = np.zeros((len(days), len(thresholds), len(columns)), "<u2"), np.zeros((len(days), len(thresholds)), bool)
        at = np.searchsorted(days, rows["date"].to_numpy())
        which = rows["threshold"].map({t: k for k, t in enumerate(thresholds)}).to_numpy()
        cube[at, which], valid[at, which] = rows[columns].to_numpy(), True
        return pd.DataFrame({"world": [rows["world"].iloc[0]], "first_date": [days[0]], "n_days": [len(days)], "gaps": [int((np.diff(offsets) != 1).sum())], "offsets": [compress(offsets.tobytes(), quality)], "cube": [compress(cube.tobytes(), quality)], "valid": [compress(np.packbits(valid.ravel()).tobytes(), quality)]})

    small = quantised(extent.where(F.col("threshold").isin(*thresholds)).select("world", "date", "threshold", *columns), columns)
    return small.groupBy("world").applyInPandas(pack, "world string, first_date date, n_days int, gaps int, offsets binary, cube binary, valid binary")


def unpack_extent(cubes: DataFrame, columns: list[str], thresholds: list[str]) -> DataFrame:
    """(world, date, threshold, columns as whole numbers) of what pack_extent() made; gaps in the days stay gaps, and days that a threshold lacks have no row."""

    def unpack(batches):
        for batch in batches:
            for r in batch.itertuples():
                n = r.n_days * len(thresholds)
                valid = np.unpackbits(np.frombuffer(expand(r.valid, -(-n // 8)), np.uint8), count=n).astype(bool)
                offsets = np.frombuffer(expand(r.offsets, 4 * r.n_days), "<i4")
                cube = np.frombuffer(expand(r.cube, 2 * r.n_days * len(thresholds) * len(columns)), "<u2").reshape(-1, len(columns))
                out = pd.DataFrame(cube.astype(np.int64), columns=columns)
                days = pd.to_datetime(pd.Series([r.first_date] * r.n_days)) + pd.to_timedelta(offsets, unit="D")
                out.insert(0, "threshold", np.tile(thresholds, r.n_days))
                out.insert(0, "date", days.dt.date.repeat(len(thresholds)).to_numpy())
                out.insert(0, "world", r.world)
                yield out[valid]

    kinds = ", ".join(f"`{c}` long" for c in columns)
    return cubes.select("world", "first_date", "n_days", "offsets", "cube", "valid").mapInPandas(unpack, f"world string, date date, threshold string, {kinds}")


def extent_at(small: DataFrame, date: str, threshold: str, column: str) -> DataFrame:
    """(world, value) of a day in quantised extents; NULL where the day is missing."""
    found = small.where((F.col("date") == F.lit(date).cast("date")) & (F.col("threshold") == threshold)).select("world", (F.col(column) / float(SCALE)).alias("value"))
    return small.select("world").distinct().join(found, "world", "left")


def manifest(blocks: DataFrame, cubes: DataFrame, columns: list[str], region_names: dict[int, str]) -> dict:
    """The bundle's table of contents; blocks and cubes are a few rows."""
    worlds: dict = {}
    for r in blocks.select("world", "threshold", "chunk", "first_year", "n_frames", "n_cells", F.length("blob").alias("bytes")).orderBy("world", "threshold", "chunk").collect():
        worlds.setdefault(r.world, {"thresholds": {}})["thresholds"].setdefault(r.threshold, []).append({"first_year": r.first_year, "n_frames": r.n_frames, "n_cells": r.n_cells, "bytes": r.bytes})
    for r in cubes.select("world", "first_date", "n_days", "gaps").collect():
        worlds.setdefault(r.world, {"thresholds": {}})["extent"] = {"first_date": str(r.first_date), "n_days": r.n_days, "gaps": r.gaps, "scale": SCALE, "columns": columns}
    return {"worlds": worlds, "region_names": {str(k): v for k, v in region_names.items()}}


def merged_manifest(old: str | None, new: dict) -> str:
    """The old manifest's JSON with the new one's worlds in place of its own."""
    base = json.loads(old) if old else {"worlds": {}}
    return json.dumps(base | new | {"worlds": base.get("worlds", {}) | new["worlds"]}, sort_keys=True)


def bundle_files(blocks: DataFrame, cubes: DataFrame, index: DataFrame) -> DataFrame:
    """(file, place, data) of a bundle's blobs; a place is what the manifest has before names are known."""
    last = F.col("first_year") + F.col("n_frames") / 12 - 1
    of = F.concat_ws("/", "world", "threshold", F.concat_ws("-", "first_year", last.cast("int")))
    frames = blocks.select(F.concat(of, F.lit(".bin.br")).alias("file"), of.alias("place"), F.col("blob").alias("data"))
    days = [cubes.select(F.concat(F.lit("extent/"), "world", F.lit(f"{end}.bin.br")).alias("file"), F.concat(F.lit("extent/"), "world", F.lit(end)).alias("place"), F.col(c).alias("data")) for end, c in (("", "cube"), ("_days", "offsets"))]

    @F.pandas_udf("binary")
    def ordered(lists: pd.Series) -> pd.Series:
        return pd.Series([compress(np.array([c["cell_id"] for c in sorted(x, key=lambda c: c["pos"])], "<i4").tobytes(), 11) for x in lists])

    cells = index.agg(F.collect_list(F.struct("pos", "cell_id")).alias("cells"))  # the grid bounds how many there are
    cells = cells.select(F.lit("cells.bin.br").alias("file"), F.lit("cells").alias("place"), ordered("cells").alias("data"))
    return frames.unionByName(days[0]).unionByName(days[1]).unionByName(cells)


def bundle_manifest(blocks: DataFrame, cubes: DataFrame, index: DataFrame, kept: dict, observed: dict, thresholds: list[str]) -> dict:
    """The manifest of bundle_files(), with places for names. kept is manifest()'s, observed days by (world, year, month)."""
    n_cells, worlds = index.count(), {}
    for r in blocks.select("world", "threshold", "first_year", "n_frames").orderBy("world", "threshold", "first_year").collect():  # a row a blob
        last = r.first_year + r.n_frames // 12 - 1
        own = worlds.setdefault(r.world, {"thresholds": {}, "years": [r.first_year, last], "n_cells": n_cells, "region_names": kept.get("region_names", {})})
        own["years"] = [min(own["years"][0], r.first_year), max(own["years"][1], last)]
        own["thresholds"].setdefault(r.threshold, []).append({"file": f"{r.world}/{r.threshold}/{r.first_year}-{last}", "first_year": r.first_year, "n_months": r.n_frames})
    for r in cubes.select("world", "first_date", "n_days", "gaps").collect():
        columns = kept["worlds"][r.world]["extent"]["columns"]
        worlds[r.world]["extent"] = {"file": f"extent/{r.world}", "days_file": f"extent/{r.world}_days", "days_dtype": "int32", "dtype": "uint16", "scale": SCALE, "shape": [r.n_days, len(thresholds), len(columns)], "thresholds": thresholds, "columns": columns, "first_date": str(r.first_date), "n_days": r.n_days, "gaps": r.gaps}
    for world, own in worlds.items():
        own["days_observed"] = [observed.get((world, y, m), 0) for y in range(own["years"][0], own["years"][1] + 1) for m in range(1, 13)]
    return {"worlds": worlds, "cells": {"file": "cells", "n_cells": n_cells, "digest": kept.get("cells")}}
