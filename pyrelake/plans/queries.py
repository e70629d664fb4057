"""The catalogue: every operator applied to the test tables, one query each."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, names, values
from ..operators import analytics, calendar, exceedance, histogram, listing, masks, packing
from ..operators import thresholds as thr
from ..sources import readers
from . import testdata

SETTINGS = testdata.SETTINGS
REGIONS = [1, 2, 3, 4, 5]
PERIODS = [(1995, 1996), (1997, 1998), (1999, 2001)]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


class Data:
    """The relations of one run, made when they are first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    cells = cached_property(lambda self: testdata.cells(self.spark, self.sf))
    daily = cached_property(lambda self: testdata.daily(self.spark, self.sf))
    events = cached_property(lambda self: testdata.events_daily(self.spark, self.sf))
    order_days = cached_property(lambda self: testdata.order_days(self.spark, self.sf))
    reference = cached_property(lambda self: thr.reference(self.daily, SETTINGS))
    hist = cached_property(lambda self: histogram.histogram(self.reference, SETTINGS.bins))
    thresholds = cached_property(lambda self: histogram.quantiles(self.hist, SETTINGS.quantiles, SETTINGS.bins))
    wide = cached_property(lambda self: histogram.wide_quantiles(self.hist, SETTINGS.quantiles, SETTINGS.bins))
    hits = cached_property(lambda self: exceedance.compared(self.daily, self.wide, SETTINGS.names))
    counts = cached_property(lambda self: exceedance.monthly(exceedance.month_sums(self.hits, SETTINGS.names), SETTINGS.names))
    observed = cached_property(lambda self: exceedance.days_observed(self.daily))
    area = cached_property(lambda self: exceedance.areas(self.cells))
    sums = cached_property(lambda self: exceedance.extent(self.daily, self.wide, self.cells, SETTINGS.names, REGIONS))
    world = cached_property(lambda self: exceedance.fractions(exceedance.extent(self.daily, self.wide, self.cells, SETTINGS.names), self.area).drop("region"))
    regions = cached_property(lambda self: exceedance.fractions(self.sums, self.area, REGIONS))
    table = cached_property(lambda self: exceedance.wide_extent(self.sums, self.area, REGIONS))
    annual = cached_property(lambda self: analytics.annual(self.world))
    gaps = cached_property(lambda self: analytics.extra_days(self.counts, self.cells, list(range(1995, 2002))))
    nodes = cached_property(lambda self: self.cells.select("cell_id", "lat", "lon"))


#: A coarse source grid for the regridding queries: centres 3 degrees apart.
SOURCE = masks.SourceGrid(-88.5, 60, -178.5, 120, 3.0)


def source_cells(d: Data) -> DataFrame:
    """Customers placed on the source grid; where several meet, the largest code counts, and some places have none."""
    k = F.col("c_custkey")
    placed = testdata.table(d.spark, d.sf, "customer").select(((k * 7) % SOURCE.n_lat).cast("int").alias("lat_idx"), ((k * 13) % SOURCE.n_lon).cast("int").alias("lon_idx"), (F.col("c_nationkey") % 21).cast("int").alias("code"))
    return masks.burnable_classes(placed.groupBy("lat_idx", "lon_idx").agg(F.max("code").alias("code")), SETTINGS.burnable)


def corner_nodes(d: Data) -> DataFrame:
    """Cells where they are, and once more moved to the nearest corner of four source cells, poles and date line too."""
    moved = d.nodes.select((-1 - F.col("cell_id")).alias("cell_id"), (F.rint(F.col("lat") / 3) * 3).alias("lat"), (F.rint(F.col("lon") / 3) * 3).alias("lon"))
    return d.nodes.unionByName(moved)


def hist_counts(d: Data) -> DataFrame:
    return d.hist


def hist_overflow(d: Data) -> DataFrame:
    return histogram.samples(histogram.histogram(d.events, SETTINGS.bins), SETTINGS.bins)


def hist_quantiles(d: Data) -> DataFrame:
    return rounded(d.thresholds.select("cell_id", "threshold", "thr"), "thr")


def hist_merge_resume(d: Data) -> DataFrame:
    early, late = (histogram.histogram(d.reference.where(c), SETTINGS.bins) for c in ("year(date) <= 1997", "year(date) > 1997"))
    return histogram.resumed(early, late, SETTINGS.bins)


def bin_edges(d: Data) -> DataFrame:
    """The bins that values of the reference fall into, with their edges."""
    b = SETTINGS.bins
    seen = d.hist.groupBy("bin").agg(F.sum("n").alias("n"))
    return rounded(seen.select("bin", "n", histogram.lower_edge(F.col("bin"), b).alias("edge"), histogram.width(F.col("bin"), b).alias("width")), "edge", "width")


def clean_values(d: Data) -> DataFrame:
    """Fills are made here: negatives where a line was returned, NaN where it was accepted."""
    lines = testdata.table(d.spark, d.sf, "lineitem")
    raw = F.when(F.col("l_returnflag") == "R", -1.0).when(F.col("l_returnflag") == "A", float("nan")).otherwise(F.col("l_extendedprice"))
    return lines.select("l_returnflag", values.clean(raw).alias("v")).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("v").alias("n_valid"))


def exact_percentiles(d: Data) -> DataFrame:
    return rounded(thr.exact(d.reference, SETTINGS.quantiles).select("cell_id", "threshold", "thr"), "thr")


def threshold_validation(d: Data) -> DataFrame:
    return rounded(thr.validation(d.daily, SETTINGS), "max_err", "mean_err", "p99_err")


def ref_coverage(d: Data) -> DataFrame:
    c = calendar.coverage(calendar.days_seen(d.reference))
    return c.select("n_days", "first_date", "last_date", F.concat_ws(",", F.transform("years", lambda y: y.cast("string"))).alias("years"), F.size("missing_days").cast("long").alias("n_missing"))


def missing_days(d: Data) -> DataFrame:
    return calendar.missing_days(d.order_days, calendar.between_ends(d.order_days))


def day_gaps(d: Data) -> DataFrame:
    return calendar.day_gaps(d.order_days).withColumn("step", F.col("step").cast("long"))


def duplicate_days(d: Data) -> DataFrame:
    slabs = testdata.table(d.spark, d.sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_orderstatus").distinct()
    return calendar.duplicate_days(slabs)


def short_tail_vs_hole(d: Data) -> DataFrame:
    dates = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("first_missing", "hole")}
    return calendar.year_verdicts(d.order_days).withColumns({"year": F.col("year").cast("long"), **dates})


def monthly_exceedance(d: Data) -> DataFrame:
    return d.counts.select("world", F.col("year").cast("long"), F.col("month").cast("long"), "cell_id", "threshold", "days")


def monthly_dense(d: Data) -> DataFrame:
    years = d.observed.select("world", "year").distinct()
    out = exceedance.dense_monthly(d.counts, d.cells.where("burnable"), years, SETTINGS.names)
    return out.select("world", F.col("year").cast("long"), F.col("month").cast("long"), "cell_id", "threshold", "days")


def days_observed(d: Data) -> DataFrame:
    return d.observed.select("world", F.col("year").cast("long"), F.col("month").cast("long"), "days")


def days_in_month(d: Data) -> DataFrame:
    """The months of orders, with the days that they have, have had orders, and have 108 years on (2100 is no leap year)."""
    months = d.order_days.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias("days_seen"))
    days = lambda year: values.days_in_month(year, F.col("month")).cast("long")
    return months.select(F.col("year").cast("long"), F.col("month").cast("long"), "days_seen", days(F.col("year")).alias("days"), days(F.col("year") + 108).alias("days_later"))


_FRACTIONS = ("fraction", "fraction_observed", "coverage")


def extent_global(d: Data) -> DataFrame:
    return rounded(d.world, *_FRACTIONS)


def extent_regions(d: Data) -> DataFrame:
    return rounded(d.regions.withColumn("region", F.col("region").cast("long")), *_FRACTIONS)


def extent_wide(d: Data) -> DataFrame:
    return rounded(d.table, *d.table.columns[3:])


def extent_observed_fraction(d: Data) -> DataFrame:
    out = d.world.groupBy("world", "threshold", F.year("date").cast("long").alias("year")).agg(F.avg(values.ratio(F.col("fraction"), F.col("coverage"))).alias("observed_fraction"))
    return rounded(out, "observed_fraction")


def coverage_by_month(d: Data) -> DataFrame:
    return rounded(analytics.coverage_by_month(d.world).withColumn("month", F.col("month").cast("long")), *_FRACTIONS)


def year_summary(d: Data) -> DataFrame:
    out = exceedance.year_summary(d.world, d.observed)
    return rounded(out.withColumn("year", F.col("year").cast("long")), "mean_coverage")


def annual_mean(d: Data) -> DataFrame:
    return rounded(d.annual.withColumn("year", F.col("year").cast("long")), "percent")


_WORLDS = ("observed", "counterfactual", "gap")


def world_gap(d: Data) -> DataFrame:
    return rounded(analytics.side_by_side(d.world, ["threshold", "date"], "fraction"), *_WORLDS)


def period_means(d: Data) -> DataFrame:
    return rounded(analytics.period_means(d.annual, PERIODS), *_WORLDS)


def decade_extra_days(d: Data) -> DataFrame:
    return rounded(d.gaps, *_WORLDS)


def gap_statistics(d: Data) -> DataFrame:
    return rounded(analytics.gap_statistics(d.gaps), "mean_gap", "p99_abs_gap")


def gap_top_cells(d: Data) -> DataFrame:
    return analytics.top_gaps(rounded(d.gaps, *_WORLDS), 10)


def trend_slopes(d: Data) -> DataFrame:
    return rounded(analytics.trends(d.annual), "slope", "slope_se", digits=5)


def trend_attribution(d: Data) -> DataFrame:
    return rounded(analytics.attributable(analytics.trends(d.annual)), *_WORLDS, "attributable_share", digits=4)


def sync_days(d: Data) -> DataFrame:
    out = analytics.synchronous_days(d.regions.withColumn("fraction", F.round("fraction", 9)), 0.05)
    return out.select("world", "threshold", F.col("region").cast("long"), F.col("year").cast("long"), "days")


def sync_factor(d: Data) -> DataFrame:
    days = analytics.synchronous_days(d.regions.withColumn("fraction", F.round("fraction", 9)), 0.05)
    return rounded(analytics.synchrony_factor(days, (1995, 1997), (1999, 2001)).withColumn("region", F.col("region").cast("long")), "early", "late", "factor")


def month_fraction_interp(d: Data) -> DataFrame:
    out = analytics.between_months(analytics.monthly_shares(d.counts, d.observed, 1995), 0.25)
    return rounded(out.select("world", "threshold", "cell_id", F.col("month_idx").cast("long"), "share", "value"), "share", "value")


def spells(d: Data) -> DataFrame:
    return analytics.spells(d.hits, SETTINGS.names)


def spell_statistics(d: Data) -> DataFrame:
    return analytics.spell_statistics(spells(d)).withColumn("year", F.col("year").cast("long"))


def burnable_mask(d: Data) -> DataFrame:
    return masks.burnable_classes(d.cells.select("cell_id", F.col("cls").alias("code")), SETTINGS.burnable).select("cell_id", F.col("code").cast("long"), "burnable")


def burnable_share(d: Data) -> DataFrame:
    return rounded(masks.burnable_share(d.cells), "share")


def regrid_vote(d: Data) -> DataFrame:
    return masks.vote(corner_nodes(d), source_cells(d), SOURCE, SETTINGS.vote)


def regrid_nw(d: Data) -> DataFrame:
    return masks.north_west(corner_nodes(d), source_cells(d), SOURCE).withColumn("code", F.col("code").cast("long"))


def mask_assembly(d: Data) -> DataFrame:
    nodes = corner_nodes(d).withColumn("w", grid.area_weight(F.col("lat")))
    regions = source_cells(d).select("lat_idx", "lon_idx", (F.col("code") % 5).alias("code"))
    out = masks.masks(nodes, source_cells(d).drop("burnable"), SOURCE, regions, SOURCE, SETTINGS.burnable, SETTINGS.vote)
    return rounded(out.withColumn("region", F.col("region").cast("long")), "w")


def canonicalise_lon(d: Data) -> DataFrame:
    """Cells given from 0 to 359.75 degrees find their columns again."""
    turned = d.cells.select("cell_id", "lat", F.pmod("lon", F.lit(360.0)).alias("lon"), F.lit(1.0).alias("fwi"))
    back = readers.check_canonical(readers.canonical(turned.withColumnRenamed("cell_id", "id")))
    return back.select(F.col("id").alias("cell_id"), F.col("cell_id").alias("grid_cell"))


def grid_weights(d: Data) -> DataFrame:
    """Rows of the grid that have cells: latitude, weight, and how many."""
    row = grid.row_of(F.col("lat"))
    rows = d.cells.groupBy(row.cast("long").alias("grid_row")).agg(F.count("*").alias("n_cells"))
    lat = grid.latitude(F.col("grid_row"))
    return rounded(rows.select("grid_row", "n_cells", lat.alias("lat"), grid.area_weight(lat).alias("w")), "w", digits=9)


def angular_distance(d: Data) -> DataFrame:
    return rounded(d.cells.select("cell_id", grid.angular_distance(F.col("lon") * 3, F.lit(170.0)).alias("distance"), grid.signed_longitude(F.col("lon") + 400.0).alias("turned")), "distance", "turned")


def equal_earth(d: Data) -> DataFrame:
    x, y = grid.equal_earth(F.col("lon"), F.col("lat"))
    lon, lat = grid.equal_earth_inverse(F.col("x"), F.col("y"))
    return rounded(d.cells.where("abs(lat) < 89").select("cell_id", x.alias("x"), y.alias("y")).select("cell_id", "x", "y", lon.alias("lon"), lat.alias("lat")), "x", "y", "lon", "lat", digits=5)


def cell_index(d: Data) -> DataFrame:
    return packing.cell_index(d.cells)


def frame_chunks(d: Data) -> DataFrame:
    years = d.counts.select("year").distinct()
    return packing.frame_chunks(years, 3).select(*[F.col(c).cast("long") for c in ("chunk", "first_year", "n_frames")])


def frame_scatter(d: Data) -> DataFrame:
    one = d.counts.where("world = 'observed' AND threshold = 'p90' AND year = 1997 AND month = 3").join(d.cells.where("burnable").select("cell_id"), "cell_id", "left_semi")
    return packing.scattered(one, d.cells)


def pack_roundtrip(d: Data) -> DataFrame:
    index = packing.cell_index(d.cells)
    blocks = packing.pack_frames(d.counts, index, 1995, 3)
    return packing.unpack_frames(blocks, index).select("world", "threshold", F.col("year").cast("long"), F.col("month").cast("long"), "cell_id", "days")


def blob_totals(d: Data) -> DataFrame:
    """What the blobs of a world hold when they are opened again; that they take less than half of it is said too."""
    blocks = packing.raw_sizes(packing.pack_frames(d.counts, packing.cell_index(d.cells), 1995, 3))
    return blocks.groupBy("world").agg(F.count("*").alias("blobs"), F.sum("raw_bytes").alias("raw_bytes"), (2 * F.sum("packed_bytes") < F.sum("raw_bytes")).alias("halved"))


def frame_lookup(d: Data) -> DataFrame:
    blocks = packing.pack_frames(d.counts, packing.cell_index(d.cells), 1995, 3)
    return packing.frame_at(blocks, "observed", "p90", 40).select("world", "threshold", F.col("month_idx").cast("long"), F.lower(F.hex("frame")).alias("frame"))


_PACKED = ["global", "coverage", *(f"region_{k}{x}" for k in REGIONS for x in ("", "_cov"))]


def _quantised(d: Data) -> DataFrame:
    return packing.quantised(rounded(d.table, *_PACKED, digits=9), _PACKED)


def extent_quantised(d: Data) -> DataFrame:
    return _quantised(d).withColumns({c: F.col(c).cast("long") for c in _PACKED})


def extent_cube(d: Data) -> DataFrame:
    return packing.pack_extent(rounded(d.table, *_PACKED, digits=9), _PACKED, SETTINGS.names).select("world", "first_date", F.col("n_days").cast("long"), F.col("gaps").cast("long"))


def extent_cube_roundtrip(d: Data) -> DataFrame:
    wide = rounded(d.table, *_PACKED, digits=9)
    return packing.unpack_extent(packing.pack_extent(wide, _PACKED, SETTINGS.names), _PACKED, SETTINGS.names)


def day_offsets(d: Data) -> DataFrame:
    return packing.day_offsets(d.order_days).withColumn("day_offset", F.col("day_offset").cast("long"))


def extent_at(d: Data) -> DataFrame:
    return packing.extent_at(_quantised(d), "1996-06-15", "p90", "global")


def uneven_thresholds(d: Data) -> DataFrame:
    return packing.uneven_thresholds(d.world.where("NOT (threshold = 'p99' AND month(date) = 2)"))


def readout(d: Data) -> DataFrame:
    return analytics.readout(d.world.withColumn("fraction", F.round("fraction", 9)), "p90")


def year_spec(d: Data) -> DataFrame:
    """A range and a single year, as text, of every supplier."""
    first = 1980 + F.col("s_suppkey") % 20
    spec = F.concat(first.cast("string"), F.lit("-"), (first + 2).cast("string"), F.lit(" , "), (1978 + F.col("s_nationkey")).cast("string"))
    out = testdata.table(d.spark, d.sf, "supplier").select(F.col("s_suppkey").alias("id"), F.explode(names.years_in(spec)).alias("year"))
    return out.withColumn("year", F.col("year").cast("long"))


def _outputs(d: Data) -> DataFrame:
    """(path, extent) of yearly outputs: a year for every supplier, by its balance."""
    s = testdata.table(d.spark, d.sf, "supplier")
    year = (1900 + F.floor(F.abs("s_acctbal")) % 200).cast("string")
    extent = F.col("s_nationkey") % 2 == 1
    return s.select(F.concat(F.lit("out/observed_"), year, F.when(extent, "_extent.parquet").otherwise(".nc")).alias("path"), extent.alias("extent"))


def paired_years(d: Data) -> DataFrame:
    out = _outputs(d)
    return listing.paired_years(out.where("NOT extent"), out.where("extent")).withColumn("year", F.col("year").cast("long"))


def year_gaps(d: Data) -> DataFrame:
    return calendar.missing_years(_outputs(d).select(names.year_of(F.col("path")).alias("year")).distinct()).withColumn("year", F.col("year").cast("long"))


def _files(d: Data) -> DataFrame:
    """(k, nation, path, size, digest): a file for every supplier, of either world, or of none."""
    k = F.col("s_suppkey")
    year = (1900 + F.floor(k / 2) % 200).cast("string")
    path = F.when(k % 5 == 0, F.concat(F.lit("notes_"), k.cast("string"), F.lit(".md"))).otherwise(F.concat(F.when(k % 2 == 1, "fwi_era5_").otherwise("fwi_era5_counter_"), year, F.lit(".nc")))
    return testdata.table(d.spark, d.sf, "supplier").select(k.alias("k"), F.col("s_nationkey").alias("nation"), path.alias("path"), (100 + k).alias("size"), F.sha2("s_name", 256).alias("digest"))


def _listing(d: Data, files: DataFrame | None = None) -> DataFrame:
    """A page of the archive's JSON for every nation, read again; links of half the files are relative, and digests in capitals."""
    files = _files(d) if files is None else files
    href = F.concat(F.when(F.col("k") % 2 == 0, "/api/").otherwise("https://host.example/api/"), F.col("path"))
    link = F.struct(F.struct(href.alias("href")).alias("stash:download"))
    file = F.struct("path", "size", F.lit("sha-256").alias("digestType"), F.upper("digest").alias("digest"), link.alias("_links"))
    pages = files.groupBy("nation").agg(F.collect_list(file).alias("files"))
    return listing.entries(pages.select(F.to_json(F.struct(F.struct(F.col("files").alias("stash:files")).alias("_embedded"))).alias("json")), "https://archive.example")


def manifest_entries(d: Data) -> DataFrame:
    return _listing(d).withColumn("year", F.coalesce(F.col("year").cast("long"), F.lit(0)))


def download_order(d: Data) -> DataFrame:
    out = listing.fetch_order(_listing(d), 1991, 2020)
    return out.select("path", F.col("tier").cast("long"), F.coalesce(F.col("year").cast("long"), F.lit(0)).alias("year"), F.col("world_rank").cast("long"))


def years_wanted(d: Data) -> DataFrame:
    return listing.of_years(_listing(d), [1905, 1910, 1941]).select("path")


def file_status(d: Data) -> DataFrame:
    """Local copies: of seven files one is not there, one is half, one is another, and one has not been read.

    Names come again every 200 years, so each file is in a folder of its own.
    """
    files = _files(d).withColumn("path", F.concat_ws("/", F.col("k"), "path"))
    kind = F.col("k") % 7
    size, digest = F.when(kind == 1, F.floor(F.col("size") / 2)).otherwise(F.col("size")), F.when(kind == 2, F.sha2("path", 256)).when(kind != 3, F.col("digest"))
    local = files.where(kind != 0).select("path", size.cast("long").alias("size"), digest.alias("sha256"))
    return listing.status(_listing(d, files), local).withColumn("path", F.substring_index("path", "/", -1))


def status_counts(d: Data) -> DataFrame:
    return file_status(d).groupBy("status").agg(F.count("*").alias("n"))


def epoch_parse(d: Data) -> DataFrame:
    """Units of time axes that begin on the day of an order, in three spellings; hours are none."""
    o = testdata.table(d.spark, d.sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    plain = F.concat_ws("-", F.year("day"), F.month("day"), F.dayofmonth("day"))
    terse = F.concat(F.date_format("day", "MMM"), F.dayofmonth("day"), F.year("day"))
    units = F.when(F.col("id") % 5 == 0, F.concat(F.lit("hours since "), plain)).when(F.col("id") % 2 == 0, F.concat(F.lit("days since "), plain, F.lit(" 00:00"))).otherwise(F.concat(F.lit("days_since_"), terse))
    epoch = names.epoch_of(F.col("units"))
    return o.select("id", units.alias("units")).select("id", *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in (("epoch", epoch), ("a_year_on", F.date_add(epoch, 365)))])


def month_labels(d: Data) -> DataFrame:
    """The months of the daily values by their place, and back."""
    months = d.daily.select(((F.year("date") - 1992) * 12 + F.month("date") - 1).cast("long").alias("month_idx")).distinct()
    year, month = values.month_label(F.col("month_idx"), F.lit(1992))
    return months.select("month_idx", year.cast("long").alias("year"), month.cast("long").alias("month"), values.day_within(F.col("month_idx"), F.lit(1992)).alias("mid_day"))


QUERIES = {
    f.__name__: f
    for f in (
        hist_counts, hist_overflow, hist_quantiles, hist_merge_resume, bin_edges, clean_values, exact_percentiles, threshold_validation, ref_coverage, missing_days, day_gaps, duplicate_days,
        short_tail_vs_hole, monthly_exceedance, monthly_dense, days_observed, days_in_month, extent_global, extent_regions, extent_wide, extent_observed_fraction, coverage_by_month, year_summary,
        annual_mean, world_gap, period_means, decade_extra_days, gap_statistics, gap_top_cells, trend_slopes, trend_attribution, sync_days, sync_factor, month_fraction_interp, spells, spell_statistics, burnable_mask,
        burnable_share, regrid_vote, regrid_nw, mask_assembly, canonicalise_lon, grid_weights, angular_distance, equal_earth, cell_index, frame_chunks, frame_scatter, pack_roundtrip, blob_totals,
        frame_lookup, extent_quantised, extent_cube, extent_cube_roundtrip, day_offsets, extent_at, uneven_thresholds, readout, year_spec, paired_years, year_gaps, manifest_entries, download_order, years_wanted,
        file_status, status_counts, epoch_parse, month_labels,
    )
}


def queries() -> dict:
    """Each query as (spark, sf_dir) -> DataFrame."""
    return {name: lambda spark, sf, f=f: f(Data(spark, sf)) for name, f in QUERIES.items()}
