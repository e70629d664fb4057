"""Masks: cell-centred grids of classes and regions brought to the canonical grid's nodes.

A node lies at the corner of four source cells. Their indices follow from its coordinates by arithmetic, so
the neighbours are found by an equality join on indices rather than a range join on coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import angular_distance
from ..functions.values import ratio
from .calendar import refuse

EPSILON = 1e-6


class SourceGrid:
    """An axis-aligned, evenly spaced source grid: first centre and count of latitudes (ascending) and longitudes (periodic)."""

    def __init__(self, lat0: float, n_lat: int, lon0: float, n_lon: int, step: float):
        if step <= 0:
            raise ValueError("source coordinates must ascend")
        self.lat0, self.n_lat, self.lon0, self.n_lon, self.step = lat0, n_lat, lon0, n_lon, step

    def low(self, coordinate: Column, first: float) -> Column:
        """Index of the nearest centre at or below a coordinate's."""
        return F.floor((coordinate - first) / self.step - 0.5 + EPSILON).cast("int")


def neighbours(nodes: DataFrame, grid: SourceGrid) -> DataFrame:
    """nodes (cell_id, lat, lon) with the source cells within half a step: lat_idx, lon_idx, and inside (a latitude the source has)."""
    spread = lambda c, first: F.explode(F.array(grid.low(c, first), grid.low(c, first) + 1))
    out = nodes.select("*", spread(F.col("lat"), grid.lat0).alias("i")).select("*", spread(F.col("lon"), grid.lon0).alias("j"))
    near = (F.abs(grid.lat0 + F.col("i") * grid.step - F.col("lat")) <= grid.step / 2 + EPSILON) & (angular_distance(grid.lon0 + F.col("j") * grid.step, F.col("lon")) <= grid.step / 2 + EPSILON)
    return out.where(near).select(*nodes.columns, F.col("i").alias("lat_idx"), F.pmod("j", F.lit(grid.n_lon)).alias("lon_idx"), F.col("i").between(0, grid.n_lat - 1).alias("inside"))


def vote(nodes: DataFrame, source: DataFrame, grid: SourceGrid, least: float = 0.5) -> DataFrame:
    """(cell_id, yes, of, burnable): the neighbours of source (lat_idx, lon_idx, burnable) that say yes; those outside say no."""
    seen = neighbours(nodes, grid).join(source.select("lat_idx", "lon_idx", "burnable"), ["lat_idx", "lon_idx"], "left")
    counted = seen.groupBy("cell_id").agg(F.count_if(F.col("inside") & F.coalesce("burnable", F.lit(False))).alias("yes"), F.count("*").alias("of"))
    return counted.withColumn("burnable", F.col("yes") / F.col("of") >= least)


def north_west(nodes: DataFrame, source: DataFrame, grid: SourceGrid, fill: int = 0) -> DataFrame:
    """(cell_id, code) of the source cell to the north-west; fill where there is none. For grids half a step off."""
    i, j = grid.low(F.col("lat"), grid.lat0) + 1, grid.low(F.col("lon"), grid.lon0)
    beside = (F.abs(grid.lat0 + i * grid.step - F.col("lat")) <= grid.step / 2 + EPSILON) & (angular_distance(grid.lon0 + j * grid.step, F.col("lon")) <= grid.step / 2 + EPSILON)
    keyed = nodes.select("cell_id", F.when(beside, i).alias("lat_idx"), F.pmod(j, F.lit(grid.n_lon)).alias("lon_idx"))
    return keyed.join(source.select("lat_idx", "lon_idx", "code"), ["lat_idx", "lon_idx"], "left").select("cell_id", F.coalesce("code", F.lit(fill)).alias("code"))


def burnable_classes(classes: DataFrame, burnable: tuple[int, ...]) -> DataFrame:
    """Class codes as a mask; a missing code is water, class 0."""
    code = F.coalesce(F.nanvl(F.col("code").cast("double"), F.lit(0.0)).cast("int"), F.lit(0))
    return classes.withColumn("code", code).withColumn("burnable", F.col("code").isin(*burnable))


def check_source(source: DataFrame, grid: SourceGrid) -> None:
    """Refuses a source whose coordinates are not those of its grid, or that does not go round the globe."""
    off = (F.abs(F.col("lat") - (grid.lat0 + F.col("lat_idx") * grid.step)) > 1e-4) | (F.abs(F.col("lon") - (grid.lon0 + F.col("lon_idx") * grid.step)) > 1e-4)
    refuse(source.where(off).select("lat_idx", "lon_idx", "lat", "lon"), "coordinates that the grid does not have")
    if abs(grid.n_lon * grid.step - 360) > 1e-6:
        raise ValueError(f"{grid.n_lon} columns of {grid.step} degrees do not go round the globe")


def masks(nodes: DataFrame, classes: DataFrame, class_grid: SourceGrid, regions: DataFrame, region_grid: SourceGrid, burnable: tuple[int, ...], least: float = 0.5) -> DataFrame:
    """(cell_id, burnable, region, w): a vote of the classes, the region to the north-west, and the area's weight of nodes (cell_id, lat, lon, w)."""
    voted = vote(nodes.select("cell_id", "lat", "lon"), burnable_classes(classes, burnable), class_grid, least).select("cell_id", "burnable")
    placed = north_west(nodes.select("cell_id", "lat", "lon"), regions, region_grid).select("cell_id", F.col("code").alias("region"))
    out = nodes.select("cell_id", "w").join(voted, "cell_id", "left").join(placed, "cell_id", "left")
    return out.select("cell_id", F.coalesce("burnable", F.lit(False)).alias("burnable"), F.coalesce("region", F.lit(0)).alias("region"), F.col("w").cast("float").cast("double").alias("w"))


def burnable_share(cells: DataFrame) -> DataFrame:
    """One row: n_burnable, and the burnable share of all area."""
    return cells.agg(F.count_if("burnable").alias("n_burnable"), ratio(F.sum(F.when(F.col("burnable"), F.col("w")).otherwise(0.0)), F.sum("w")).alias("share"))
