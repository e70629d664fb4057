import datetime as dt

from pyrelake.config import Bins
from pyrelake.operators.histogram import histogram
from pyrelake.streaming.histogram import closed_days, once_a_day, running_histogram, running_monthly, to_table

SCHEMA = "world string, date date, cell_id long, fwi float"


def files(spark, path, n=3):
    rows = [("observed", dt.date(2021, 1, 1) + dt.timedelta(i), i % 4, float(i % 50)) for i in range(90)]
    for k in range(n):
        spark.createDataFrame(rows[k::n], SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    return spark.createDataFrame(rows, SCHEMA), spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path))


def done(query):
    query.processAllAvailable()
    query.stop()


def test_a_stream_counts_what_a_batch_counts(spark, tmp_path):
    batch, stream = files(spark, tmp_path / "in")
    done(to_table(running_histogram(stream, Bins()), "hist", str(tmp_path / "c1")))
    assert sorted(map(tuple, spark.table("hist").collect())) == sorted(map(tuple, histogram(batch, Bins()).collect()))
    thr = spark.createDataFrame([(c, 20.0) for c in range(4)], "cell_id long, p90 float")
    done(to_table(running_monthly(stream, thr, ["p90"]), "months", str(tmp_path / "c2")))
    assert spark.table("months").groupBy().sum("days").first()[0] == batch.where("fwi > 20").count()


def test_days_close_behind_the_watermark(spark, tmp_path):
    _, stream = files(spark, tmp_path / "in", 1)
    done(to_table(closed_days(stream), "closed", str(tmp_path / "c"), "append"))
    got = {r.date: r.n for r in spark.table("closed").collect()}
    assert got and max(got) < dt.date(2021, 3, 31) and set(got.values()) == {1}


def test_rows_that_come_again(spark, tmp_path):
    batch, _ = files(spark, tmp_path / "in", 1)
    batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    done(to_table(once_a_day(stream), "once", str(tmp_path / "c"), "append"))
    assert spark.table("once").count() == batch.count()
