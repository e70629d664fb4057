"""Times the catalogue's headline queries: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Beside them it gives rows a second of the two passes' heaviest sums over BENCH_ROWS daily rows (10 million; 0: none):
the given tables' daily values, repeated for other cells and stored as days and by cell.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrelake.operators import exceedance, histogram
from pyrelake.plans.queries import SETTINGS, Data, queries
from pyrelake.session import session
from pyrelake.sources import buckets

HEADLINE = (
    "hist_counts", "hist_quantiles", "exact_percentiles", "threshold_validation", "monthly_exceedance", "monthly_dense", "extent_global", "extent_regions", "extent_wide",
    "annual_mean", "world_gap", "decade_extra_days", "trend_slopes", "sync_days", "month_fraction_interp", "regrid_vote", "mask_assembly", "pack_roundtrip", "extent_cube", "spells",
)


def timed(df: DataFrame) -> float:
    began = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - began


def many_rows(spark: SparkSession, sf: str, wanted: int) -> dict[str, int]:
    """Rows a second: of a histogram and its quantiles, and of monthly counts, over days as stored and laid out by cell."""
    d, root = Data(spark, sf), tempfile.mkdtemp(prefix="bench-")
    times = max(1, wanted // max(1, d.daily.where("world = 'observed'").count()))
    cells = d.cells.count()
    again = lambda df: df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("cell_id", F.col("cell_id") + F.col("k") * cells).drop("k")
    days = again(d.daily.where("world = 'observed'").select("date", "cell_id", "fwi")).withColumn("year", F.year("date"))
    days.repartitionByRange(64, "date").write.parquet(f"{root}/days")
    plain = spark.read.parquet(f"{root}/days")
    buckets.arrange(plain, f"{root}/cells", 16)
    again(d.wide).write.parquet(f"{root}/thresholds")
    wide, n, out = spark.read.parquet(f"{root}/thresholds"), plain.count(), {"rows": plain.count()}
    for name, rows in (("by_day", plain), ("by_cell", buckets.opened(spark, f"{root}/cells"))):
        quantiles = histogram.wide_quantiles(histogram.histogram(rows, SETTINGS.bins), SETTINGS.quantiles, SETTINGS.bins)
        hits = exceedance.compared(rows.withColumn("world", F.lit("observed")).select("world", "date", "cell_id", "fwi"), wide, SETTINGS.names)
        out[f"quantiles_{name}"] = int(n / timed(quantiles))
        out[f"months_{name}"] = int(n / timed(exceedance.month_sums(hits, SETTINGS.names)))
    return out


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    found, times = queries(), {}
    found[HEADLINE[0]](spark, sf).write.format("noop").mode("overwrite").save()  # starts the session, warms the reader
    for name in HEADLINE:
        began = time.time()
        found[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    wanted = int(os.environ.get("BENCH_ROWS", "10000000"))
    rows = {"rows_a_second": many_rows(spark, sf, wanted)} if wanted else {}
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, **rows, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
