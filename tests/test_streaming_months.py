"""Months, spells and worlds over streams of the given tables, against the same by batch."""

import datetime as dt
import random

import pytest
from pyrelake.operators import analytics, exceedance
from pyrelake.plans.queries import SETTINGS, Data
from pyrelake.streaming.histogram import running_spells, worlds_as_they_arrive
from pyrelake.streaming.months import closing_months, missing_of

SCHEMA = "world string, date date, cell_id long, fwi float"
FAR = dt.date(2100, 1, 1)


def stored(spark, path, rows, schema, n=4):
    """The rows in n files, to be read one after another."""
    for k in range(n):
        spark.createDataFrame(rows[k * len(rows) // n : (k + 1) * len(rows) // n], schema).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def nearly_in_order(rows, key, days, seed):
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: key(r).toordinal() + rng.uniform(0, days))


def run(df, name, path):
    query = df.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    query.awaitTermination(240)
    return df.sparkSession.table(name).collect()


@pytest.fixture(scope="module")
def given(spark, sf):
    d = Data(spark, sf)
    rows = [tuple(r) for r in d.daily.where("year(date) BETWEEN 1995 AND 1996").select("world", "date", "cell_id", "fwi").collect()]
    return d, rows, spark.createDataFrame(d.wide.collect(), d.wide.schema)


def test_months_close_with_what_a_batch_counts(spark, tmp_path, given):
    d, rows, wide = given
    rows = nearly_in_order(rows, lambda r: r[1], 20, 1)
    again = rows[100:110]
    stream = stored(spark, tmp_path / "in", rows[:600] + again + rows[600:] + [("observed", FAR, 1, 1.0)], SCHEMA)
    got = run(closing_months(stream, wide, SETTINGS.names, "60 days"), "closing", tmp_path / "c")
    batch = exceedance.month_sums(exceedance.compared(spark.createDataFrame(rows, SCHEMA), wide, SETTINGS.names), SETTINGS.names)
    want = {(r.world, r.year, r.month, r.cell_id, n, r[f"days_{n}"], r.day_mask) for r in batch.collect() for n in SETTINGS.names}
    assert {(r.world, r.year, r.month, r.cell_id, r.threshold, r.days, r.day_mask) for r in got if r.kind == "month"} == want
    assert sorted((r.world, r.date, r.cell_id) for r in got if r.kind == "refused") == sorted(r[:3] for r in again)
    lacking = missing_of(spark.table("closing")).collect()
    one = next(r for r in lacking if r.missing)
    have = {r[1].day for r in rows if (r[0], r[2], r[1].year, r[1].month) == (one.world, one.cell_id, one.year, one.month)}
    assert have.isdisjoint(one.missing) and have | set(one.missing) == set(range(1, max(have | set(one.missing)) + 1))


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path, given):
    _, rows, wide = given
    rows = sorted(rows, key=lambda r: r[1])[:800]
    stream = stored(spark, tmp_path / "in", rows[:400], SCHEMA, 1)

    def go(sink):
        q = closing_months(stream, wide, ["p90"], "5 days").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(240)

    go(1)
    stored(spark, tmp_path / "in", [*rows[390:], ("observed", FAR, 1, 1.0)], SCHEMA, 1)  # ten rows come again in the second run
    go(2)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    want = exceedance.month_sums(exceedance.compared(spark.createDataFrame(rows, SCHEMA), wide, ["p90"]), ["p90"]).collect()
    assert {(r.world, r.year, r.month, r.cell_id): r.days for r in got if r.kind == "month"} == {(r.world, r.year, r.month, r.cell_id): r.days_p90 for r in want}
    assert sum(r.kind == "refused" for r in got) == 10


def test_spells_of_a_stream_are_those_of_a_batch(spark, tmp_path, given):
    _, _, wide = given
    start = dt.date(1996, 1, 1)
    cells = [r.cell_id for r in wide.select("cell_id").limit(4).collect()]
    rng = random.Random(2)
    rows = [("observed", start + dt.timedelta(k), c, rng.choice([0.0, 500.0])) for k in range(120) for c in cells]
    batch = {tuple(r) for r in analytics.spells(exceedance.compared(spark.createDataFrame(rows, SCHEMA), wide, SETTINGS.names), SETTINGS.names).collect()}
    lasting = 0
    for w, c, t, first, last, n in batch:
        assert n == (last - first).days + 1
        lasting = max(lasting, n)
    assert lasting > 4 and len(batch) == len({x[:4] for x in batch})
    stream = stored(spark, tmp_path / "in", [*nearly_in_order(rows, lambda r: r[1], 4, 3), ("observed", FAR, -1, 1.0)], SCHEMA)
    assert {tuple(r) for r in run(running_spells(stream, wide, SETTINGS.names, "10 days"), "spells", tmp_path / "c")} == batch


def test_worlds_meet_as_they_arrive(spark, tmp_path, given):
    d, _, _ = given
    days = [(r.world, r.date, r.threshold, r.fraction) for r in d.world.where("year(date) = 1996").collect()]
    days = [r for k, r in enumerate(sorted(days)) if k % 11]  # some days are of one world alone
    schema, of = "date date, threshold string, fraction double", {}
    for w in ("observed", "counterfactual"):
        rows = nearly_in_order([r[1:] for r in days if r[0] == w], lambda r: r[0], 20, w)
        of[w] = stored(spark, tmp_path / w, [*rows, (FAR, "p90", 0.0), (FAR + dt.timedelta(400), "p90", 0.0)], schema)
    got = run(worlds_as_they_arrive(of["observed"], of["counterfactual"], "60 days"), "meeting", tmp_path / "c")
    want = analytics.side_by_side(spark.createDataFrame(days, "world string, date date, threshold string, fraction double"), ["threshold", "date"], "fraction").collect()
    assert {tuple(r) for r in got if r.date < FAR} == {tuple(r) for r in want} and any(r.gap is None for r in want)
