import datetime as dt
import json

import numpy as np
import pytest
from pyrelake.operators import packing as pk
from pyrelake.operators.calendar import Refused

COUNTS = "world string, year int, month int, cell_id long, threshold string, days long"


def counts(spark, years, cells=(5, 9, 11)):
    return spark.createDataFrame([("observed", y, m, c, "p90", (y + m * c) % 32) for y in years for m in range(1, 13) for c in cells], COUNTS)


def index(spark, cells=(5, 9, 11)):
    return pk.cell_index(spark.createDataFrame([(c, True) for c in cells] + [(7, False)], "cell_id long, burnable boolean"))


def test_round_trip_and_chunks(spark):
    blocks = pk.pack_frames(counts(spark, (2001, 2002, 2003)), index(spark), 2001, 2)
    assert sorted((r.first_year, r.n_frames, r.n_cells) for r in blocks.collect()) == [(2001, 24, 3), (2003, 12, 3)]
    back = pk.unpack_frames(blocks, index(spark)).select(*[c.split()[0] for c in COUNTS.split(", ")])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, counts(spark, (2001, 2002, 2003)).collect()))
    years = spark.createDataFrame([(2001,), (2002,), (2003,)], "year int")
    assert sorted((r.first_year, r.n_frames) for r in pk.frame_chunks(years, 2).collect()) == [(2001, 24), (2003, 12)]
    with pytest.raises(Refused):
        pk.frame_chunks(years.where("year <> 2002"), 2)


def test_frames_by_month(spark):
    blocks = pk.pack_frames(counts(spark, (2001, 2002)), index(spark), 2001, 1)
    frame = pk.frame_at(blocks, "observed", "p90", 14).first().frame
    assert list(frame) == [(2002 + 3 * c) % 32 for c in (5, 9, 11)]
    assert pk.frame_at(blocks, "observed", "p90", 24).collect() == [] and pk.frame_at(blocks, "observed", "p95", 0).collect() == []


def test_what_does_not_fit_is_refused(spark):
    too_many = spark.createDataFrame([("observed", 2001, 1, 5, "p90", 256)], COUNTS)
    with pytest.raises(Exception, match="do not fit a byte"):
        pk.pack_frames(too_many, index(spark), 2001).collect()
    with pytest.raises((ValueError, OSError)):
        pk.expand(pk.compress(b"abc"), 2)


def test_positions_and_digests(spark):
    assert sorted(map(tuple, index(spark).collect())) == [(5, 0), (9, 1), (11, 2)]
    assert pk.index_digest(index(spark)) != pk.index_digest(index(spark, (5, 9, 12)))


def test_scatter(spark):
    frame, grid = spark.createDataFrame([(2, 0), (3, 4)], "cell_id long, days long"), spark.createDataFrame([(1,), (2,), (3,)], "cell_id long")
    assert sorted(map(tuple, pk.scattered(frame, grid).collect())) == [(1, 0, 0), (2, 0, 1), (3, 4, 5)]


def extent(spark, dates, value=0.1):
    return spark.createDataFrame([("observed", d, "p90", value + 0.001 * i, None) for i, d in enumerate(dates)], "world string, date date, threshold string, global double, coverage double")


def test_extents(spark):
    dates = [dt.date(2021, 1, d) for d in (1, 2, 4)]
    wide = extent(spark, dates)
    assert [r["global"] for r in pk.quantised(wide, ["global", "coverage"]).orderBy("date").collect()] == [1000, 1010, 1020]
    assert [r.day_offset for r in pk.day_offsets(wide.select("date")).orderBy("date").collect()] == [0, 1, 3]
    r = pk.pack_extent(wide, ["global", "coverage"], ["p90"]).first()
    assert (r.first_date, r.n_days, r.gaps) == (dates[0], 3, 1)
    assert np.frombuffer(pk.expand(r.cube, 12), "<u2").tolist() == [1000, 0, 1010, 0, 1020, 0]
    assert np.frombuffer(pk.expand(r.offsets, 12), "<i4").tolist() == [0, 1, 3]
    small = pk.quantised(wide, ["global", "coverage"])
    assert pk.extent_at(small, "2021-01-02", "p90", "global").first().value == pytest.approx(0.101)
    assert pk.extent_at(small, "2021-01-03", "p90", "global").first().value is None
    uneven = wide.unionByName(spark.createDataFrame([("observed", dates[0], "p99", 0.0, 0.0)], wide.schema))
    with pytest.raises(Exception, match="thresholds with other days"):
        pk.pack_extent(uneven, ["global"], ["p90", "p99"]).collect()
    for world in (uneven, wide):
        axis = pk.pack_extent(world, ["global"], ["p90", "p99"], reindex=True)
        back = pk.unpack_extent(axis, ["global"], ["p90", "p99"])
        assert sorted(map(tuple, back.collect())) == sorted((r.world, r.date, r.threshold, round(r["global"] * 10000)) for r in world.collect())
    with pytest.raises(Exception, match="come twice"):
        pk.pack_extent(wide.unionByName(wide), ["global"], ["p90"], reindex=True).collect()
    assert [(r.threshold, r.n) for r in pk.uneven_thresholds(uneven).collect()] == [("p99", 1)]


def test_manifests(spark):
    blocks = pk.pack_frames(counts(spark, (2001,)), index(spark), 2001)
    cube = pk.pack_extent(extent(spark, [dt.date(2021, 1, 1)]), ["global"], ["p90"])
    new = pk.manifest(blocks, cube, ["global"], {1: "North"})
    merged = json.loads(pk.merged_manifest(json.dumps({"worlds": {"counterfactual": {"x": 1}, "observed": {"old": 1}}}), new))
    assert set(merged["worlds"]) == {"observed", "counterfactual"} and "old" not in merged["worlds"]["observed"]
    assert merged["worlds"]["observed"]["thresholds"]["p90"][0]["n_frames"] == 12 and merged["region_names"] == {"1": "North"}
