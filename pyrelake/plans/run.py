"""The passes of a run, from stored daily values to a packed bundle.

Each reads what the one before wrote, by the layout of a root folder:
thresholds (pass 1), monthly counts and daily extents (pass 2, a year at a time is replaced), bundle.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.grid import COLUMNS, ROWS, STEP
from ..functions.grid import cells as grid_cells
from ..functions.names import WORLD_FILES
from ..operators import calendar, exceedance, histogram, masks, packing
from ..operators import thresholds as thr
from ..sources import buckets, bundle, gridded, readers
from ..sources.layout import Layout, stored_text, write_text, write_thresholds, write_years, years_stored


class NoInput(Exception):
    """Nothing to work on."""


def check_days(daily: DataFrame, months: DataFrame, allow_short_tail: bool) -> DataFrame:
    """The days of one world, or a refusal: doubled cells, days of another year, holes, short tails. months has n_rows and day_mask of daily's cells."""
    calendar.refuse(calendar.doubled(months), "cells with days that come twice")
    foreign = months.where("n_foreign > 0").select("year", "month").distinct() if "n_foreign" in months.columns else calendar.other_years(daily)
    calendar.refuse(foreign, "days of another year than their file's")
    seen = calendar.days_of(months)
    calendar.require_complete(seen, allow_short_tail)
    return seen


def require_years(spark: SparkSession, stored: DataFrame, years: list[int], allow_missing: bool) -> None:
    """Refuses years (year) that are not stored; that none is, is no input."""
    if stored.isEmpty():
        raise NoInput(f"no days in {years}")
    if not allow_missing:
        calendar.refuse(spark.createDataFrame([(y,) for y in years], "year int").join(stored, "year", "left_anti"), "years without a file")


def make_masks(spark: SparkSession, layout: Layout, settings: Settings, nodes: DataFrame, classes: DataFrame, class_grid: masks.SourceGrid, regions: DataFrame, region_grid: masks.SourceGrid) -> None:
    for source, grid in ((classes, class_grid), (regions, region_grid)):
        if {"lat", "lon"} <= set(source.columns):
            masks.check_source(source, grid)
    masks.masks(nodes, classes, class_grid, regions, region_grid, settings.burnable, settings.vote).write.mode("overwrite").parquet(layout.masks)


def make_masks_of_files(spark: SparkSession, layout: Layout, settings: Settings, classes: tuple[str, str], regions: tuple[str, str]) -> None:
    """Masks on the canonical grid, and the regions' names, from two gridded files (path, variable)."""
    spark.dataSource.register(gridded.Layer)
    (layers, grids) = zip(*[(spark.read.format("gridded_layer").option("variable", name).load(path), gridded.source_grid(path)) for path, name in (classes, regions)], strict=True)
    coded = layers[1].withColumn("code", F.coalesce(F.col("code").cast("int"), F.lit(0)))
    make_masks(spark, layout, settings, grid_cells(spark), layers[0], grids[0], coded, grids[1])
    write_text(spark, json.dumps(gridded.class_names(*regions), sort_keys=True), layout.region_names)


def ingest(spark: SparkSession, layout: Layout, world: str, path: str, names: str | None = None) -> list[int]:
    """Stores the days of a world's yearly gridded files; gives the years. Years that are stored already are replaced.

    A file with days of another year than its name's is refused before anything is written: it would replace that other year.
    Blocks of days are written as they are read, without a shuffle: names is a pattern of file names, the world's own if there is none.
    """
    try:
        days = gridded.load(spark, path, names=names or WORLD_FILES[world])
        made = days.select(F.lit(world).alias("world"), F.year("date").alias("year"), "date", "cell_id", "fwi")
        found = gridded.files(path, names or WORLD_FILES[world])
    except FileNotFoundError as e:
        raise NoInput(f"nothing at {e}") from None
    if not found:
        raise NoInput(f"no file of {world} in {path}")
    gridded.check_years(found)
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("world", "year").parquet(layout.daily)
    return years_stored(spark, layout.daily, world)


def arrange(spark: SparkSession, layout: Layout, world: str, n: int | None = None) -> int:
    """Lays a world's stored days out by cell as well; passes that sum by cell read them from there. Gives the number of buckets."""
    return buckets.arrange(readers.daily(spark, layout.daily, world), layout.by_cell(world), n)


def days_of(spark: SparkSession, layout: Layout, world: str, years: list[int]) -> DataFrame:
    """Daily values of a world's years, laid out by cell if all of the years are, and by days otherwise."""
    stored = buckets.opened(spark, layout.by_cell(world))
    if stored is not None:
        have = {r.year for r in stored.select("year").distinct().collect()}
        if have >= set(years) & set(years_stored(spark, layout.daily, world)):
            return stored.where(F.col("year").isin(*years)).withColumn("world", F.lit(world))
    return readers.daily(spark, layout.daily, world, years)


def make_thresholds(spark: SparkSession, layout: Layout, settings: Settings, allow_missing: bool = False, allow_short_tail: bool = False) -> DataFrame:
    """Pass 1, from the observed world's reference years; gives the coverage."""
    daily = days_of(spark, layout, "observed", list(settings.reference.all))
    require_years(spark, daily.select("year").distinct(), list(settings.reference.all), allow_missing)
    coverage = calendar.coverage(check_days(daily, calendar.cell_months(daily), allow_short_tail))
    write_thresholds(thr.thresholds(daily, settings), layout.thresholds(settings), settings, coverage)
    return coverage


def make_monthly(spark: SparkSession, layout: Layout, settings: Settings, world: str, years: list[int], region_ids: list[int], allow_short_tail: bool = False, allow_missing: bool = False, of: str | None = None) -> DataFrame:
    """Pass 2 for one world; gives (world, year, days, mean_coverage). Counts, days observed and extents of a year are replaced together.

    The days' values are read twice: once for sums by month and cell, of which come the checks, the counts and the days
    observed, and once for sums by day and region. of names the thresholds by their years, as 1991-2020.
    """
    daily = days_of(spark, layout, world, years)
    require_years(spark, daily.select("year").distinct(), years, allow_missing)
    cells, names = readers.masks(spark, layout.masks), settings.names
    wide = exceedance.of_the_grid(histogram.wide_thresholds(readers.thresholds(spark, layout.stored_thresholds(spark, settings, of)), names))
    months = exceedance.month_sums(exceedance.compared(daily.select("world", "year", "date", "cell_id", "fwi"), wide, names), names).persist()
    sums = exceedance.extent(daily, wide, cells, names, region_ids).persist()  # a few rows a day
    try:
        seen = check_days(daily, months, allow_short_tail)
        observed = seen.groupBy(F.lit(world).alias("world"), F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias("days"))
        write_years(exceedance.monthly(months, names), layout.monthly)
        write_years(observed, layout.observed)
        area = exceedance.areas(cells)
        write_years(exceedance.wide_extent(sums, area, region_ids).withColumn("year", F.year("date")), layout.extent)
        made = exceedance.year_summary(exceedance.fractions(sums, area), observed).collect()  # a row a year
    finally:
        months.unpersist()
        sums.unpersist()
    return spark.createDataFrame(made, "world string, year int, days long, mean_coverage double")


def make_bundle(spark: SparkSession, layout: Layout, settings: Settings, world: str, region_names: dict[int, str], years_each: int = 10, old_manifest: str | None = None, force: bool = False, quality: int = packing.QUALITY) -> str:
    """Packs a world's years that have both counts and extents; gives the manifest's JSON, which is kept in the bundle with the other worlds'.

    A bundle packed on another mask is refused unless forced: its frames would be read against the wrong cells.
    """
    counts, extents = (spark.read.parquet(p).where(F.col("world") == world) for p in (layout.monthly, layout.extent))
    years = counts.select("year").distinct().join(extents.select("year").distinct(), "year", "left_semi")
    if years.isEmpty():
        raise NoInput(f"no year of {world} has both counts and extents")
    calendar.refuse(calendar.missing_years(years), "years are missing before packing")
    cells = readers.masks(spark, layout.masks)
    calendar.refuse(packing.unfinished_years(counts.join(years, "year", "left_semi"), cells, settings.names), "years without all months and cells")
    index = packing.cell_index(cells)
    digest, path = packing.index_digest(index), f"{layout.bundle}/cells"
    try:
        before = packing.index_digest(spark.read.parquet(path))
    except Exception as e:  # noqa: BLE001  the first bundle has no cells yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        before = None
    if before not in (None, digest) and not force:
        raise calendar.Refused("the mask is not the one that the bundle was packed on")
    if before != digest:
        index.write.mode("overwrite").parquet(path)
    first = years.agg(F.min("year")).first()[0]
    blocks = packing.pack_frames(counts.join(years, "year", "left_semi"), index, first, years_each, quality)
    columns = [c for c in extents.columns if c not in ("world", "year", "date", "threshold")]
    cube = packing.pack_extent(extents.join(years, "year", "left_semi"), columns, settings.names, quality)
    for df, name in ((blocks, "frames"), (cube, "extent")):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("world").parquet(f"{layout.bundle}/{name}")
    packed, cubes = (spark.read.parquet(f"{layout.bundle}/{n}").where(F.col("world") == world) for n in ("frames", "extent"))
    grid = {"rows": ROWS, "columns": COLUMNS, "step": STEP, "first_latitude": 90.0, "first_longitude": -180.0}
    new = packing.manifest(packed, cubes, columns, region_names) | {"cells": digest, "grid": grid}
    old = old_manifest or (stored_text(spark, layout.manifest) if before == digest else None)  # worlds of another mask are not taken along
    text = packing.merged_manifest(old, new)
    write_text(spark, text, layout.manifest)
    return text


def export(spark: SparkSession, layout: Layout, settings: Settings, worlds: list[str], folder: str) -> dict:
    """The packed tables of some worlds as files in a client's form, beside those of other worlds on the same mask; gives the manifest."""
    frames, cubes = (spark.read.parquet(f"{layout.bundle}/{n}").where(F.col("world").isin(*worlds)) for n in ("frames", "extent"))
    index = spark.read.parquet(f"{layout.bundle}/cells")
    kept = json.loads(stored_text(spark, layout.manifest) or '{"worlds": {}}')
    if missing := [w for w in worlds if w not in kept["worlds"]]:
        raise NoInput(f"{', '.join(missing)} not packed")
    packed = packing.bundle_files(frames, cubes, index)
    observed = spark.read.parquet(layout.observed).where(F.col("world").isin(*worlds)).collect()  # twelve rows a year
    manifest = packing.bundle_manifest(frames, cubes, index, kept, {(r.world, r.year, r.month): r.days for r in observed}, settings.names)
    bundle.write(packed, folder, manifest)
    return bundle.read_manifest(folder)
