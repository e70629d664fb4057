"""Days above the local threshold by month, and the share of burnable area above it by day.

Both start from daily values joined to one row of thresholds a cell: a value is compared with all thresholds
where it is, and rows multiply by threshold only after they are summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import COLUMNS, ROWS
from ..functions.values import exceeds, ratio


def _long(df: DataFrame, keys: list[str], names: list[str], **columns: str) -> DataFrame:
    """One row a threshold: columns maps a name to the prefix of the wide columns that hold it, or to a column."""
    fields = lambda n: [(F.col(f"{p}{n}") if f"{p}{n}" in df.columns else F.col(p)).alias(c) for c, p in columns.items()]
    rows = F.array(*[F.struct(F.lit(n).alias("threshold"), *fields(n)) for n in names])
    return df.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def compared(daily: DataFrame, thresholds: DataFrame, names: list[str]) -> DataFrame:
    """daily with thresholds by name (wide, a row a cell); a cell without them exceeds nothing."""
    return daily.join(thresholds, "cell_id", "left").select(*daily.columns, *[exceeds(F.col("fwi"), F.col(n)).alias(f"hit_{n}") for n in names])


def month_sums(hits: DataFrame, names: list[str]) -> DataFrame:
    """(world, year, month, cell_id, days_<name>..., n_rows, day_mask): day_mask has a bit for each day of the month that has a row.

    Where hits has the year of its file, n_foreign counts days of others: refusals come from the same sums.
    """
    keys = ["world", "year", "month", "cell_id"]
    foreign = [F.count_if("_foreign").alias("n_foreign")] if "year" in hits.columns else []
    dated = hits.withColumn("_foreign", F.year("date") != F.col("year")) if foreign else hits
    dated = dated.withColumns({"year": F.year("date"), "month": F.month("date"), "day_bit": F.expr("shiftleft(1, day(date) - 1)")})
    return dated.groupBy(*keys).agg(*[F.count_if(F.col(f"hit_{n}")).alias(f"days_{n}") for n in names], F.count("*").alias("n_rows"), F.bit_or("day_bit").alias("day_mask"), *foreign)


def monthly(sums: DataFrame, names: list[str]) -> DataFrame:
    """(world, year, month, cell_id, threshold, days) of month_sums(): cells that have a row in the month."""
    return _long(sums, ["world", "year", "month", "cell_id"], names, days="days_")


def dense_monthly(counts: DataFrame, cells: DataFrame, years: DataFrame, names: list[str]) -> DataFrame:
    """All months of years (world, year) for all cells: 0 where nothing was counted."""
    months = years.select("world", "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    frame = months.select("*", F.explode(F.array(*map(F.lit, names))).alias("threshold"))
    # the frame is a few rows a year, given to every cell: it is the product that is asked for
    spine = cells.select("cell_id").crossJoin(F.broadcast(frame))
    return spine.join(counts, ["world", "year", "month", "cell_id", "threshold"], "left").select(*counts.columns[:-1], F.coalesce("days", F.lit(0)).cast("long").alias("days"))


def days_observed(daily: DataFrame) -> DataFrame:
    """(world, year, month, days): days that have a slab, whatever it holds."""
    return daily.select("world", "date").distinct().groupBy("world", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias("days"))


def areas(cells: DataFrame) -> DataFrame:
    """(region, area) of burnable cells, and with a NULL region all of them: the denominators, which days do not change."""
    burnable = cells.where("burnable")
    return burnable.groupBy("region").agg(F.sum("w").alias("area")).where("region IS NOT NULL").unionByName(burnable.agg(F.lit(None).cast("int").alias("region"), F.sum("w").alias("area")))


def of_the_grid(rows: DataFrame) -> DataFrame:
    """A table of a row a cell, marked for broadcast after counting that it has no more rows than the grid; larger ones are left to the optimizer.

    Its size cannot be guessed before it runs: a join's estimate is the product of its sides, and without the mark
    the daily values would be the side that is sent round.
    """
    return F.broadcast(rows) if rows.limit(ROWS * COLUMNS + 1).count() <= ROWS * COLUMNS else rows


def extent(daily: DataFrame, thresholds: DataFrame, cells: DataFrame, names: list[str], region_ids: list[int] | tuple = ()) -> DataFrame:
    """(world, date, threshold, region, hit_area, observed_area): region NULL is the whole world; a row for each of region_ids on every day.

    Only burnable cells meet their thresholds (wide). Values are summed once, by day and region; the world and the
    regions come from those few sums. Cells of other regions count in the world alone. A day whose values are all
    missing keeps its rows.
    """
    burnable = daily.select("world", "date", "cell_id", "fwi").join(of_the_grid(cells.where("burnable").select("cell_id", "region", "w")), "cell_id")
    found = compared(burnable, thresholds, names)
    area = lambda which: F.sum(F.when(which & F.col("fwi").isNotNull(), F.col("w")).otherwise(0.0))
    parts = found.groupBy("world", "date", *["region"] * bool(region_ids)).agg(*[area(F.col(f"hit_{n}")).alias(f"hit_{n}") for n in names], area(F.lit(True)).alias("observed"))
    here = {None: F.lit(True)} | {k: F.col("region") == k for k in region_ids}
    values = [*(f"hit_{n}" for n in names), "observed"]
    days = parts.withColumnsRenamed({v: f"{v}_None" for v in values}) if not region_ids else parts.groupBy("world", "date").agg(*[F.sum(F.when(of, F.col(v)).otherwise(0.0)).alias(f"{v}_{k}") for k, of in here.items() for v in values])
    rows = F.array(*[F.struct(F.lit(n).alias("threshold"), F.lit(k).cast("int").alias("region"), F.col(f"hit_{n}_{k}").alias("hit_area"), F.col(f"observed_{k}").alias("observed_area")) for n in names for k in here])
    return days.select("world", "date", F.explode(rows).alias("r")).select("world", "date", "r.*")


def _measured(sums: DataFrame, area: DataFrame) -> DataFrame:
    """sums with fraction, fraction_observed and coverage; area is a row a region."""
    of = area.select(F.col("region").alias("_of"), "area")
    found = sums.join(F.broadcast(of), F.col("region").eqNullSafe(F.col("_of")), "left")
    return found.select(
        "world", "date", "threshold", "region", ratio(F.col("hit_area"), F.col("area")).alias("fraction"),
        ratio(F.col("hit_area"), F.col("observed_area")).alias("fraction_observed"), ratio(F.col("observed_area"), F.col("area")).alias("coverage"),
    )


def fractions(sums: DataFrame, area: DataFrame, region_ids: list[int] | None = None) -> DataFrame:
    """(world, date, threshold, region, fraction, fraction_observed, coverage).

    fraction and coverage are of all burnable area, with or without data. With region_ids there is a row for each
    on every day, NULL where the grid has no such region; without, the rows are the whole world's.
    """
    return _measured(sums.where("region IS NULL" if region_ids is None else F.col("region").isin(region_ids)), area)


def wide_extent(sums: DataFrame, area: DataFrame, region_ids: list[int]) -> DataFrame:
    """The daily table's columns: date, threshold, global, coverage, then region_k and region_k_cov, by world."""
    pick = lambda value, k: F.max(F.when(F.col("region").eqNullSafe(F.lit(k)), F.col(value)))
    columns = [x for k in region_ids for x in (pick("fraction", k).alias(f"region_{k}"), pick("coverage", k).alias(f"region_{k}_cov"))]
    return _measured(sums, area).groupBy("world", "date", "threshold").agg(pick("fraction", None).alias("global"), pick("coverage", None).alias("coverage"), *columns)


def year_summary(whole: DataFrame, observed: DataFrame) -> DataFrame:
    """(world, year, days, mean_coverage)."""
    days = observed.groupBy("world", "year").agg(F.sum("days").alias("days"))
    return days.join(whole.groupBy("world", F.year("date").alias("year")).agg(F.avg("coverage").alias("mean_coverage")), ["world", "year"], "left")
