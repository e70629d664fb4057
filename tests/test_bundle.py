"""The bundle's writer: all of a write, or nothing of it."""

import json

import numpy as np
import pytest
from pyrelake.operators import listing, packing
from pyrelake.sources import bundle


def files(spark, days=1, broken=False):
    cells = packing.compress(np.array([5, 9], "<i4").tobytes())
    rows = [("cells.bin.br", "cells", cells)] + [(f"observed/p90/{y}-{y}.bin.br", f"observed/p90/{y}-{y}", packing.compress(bytes([days, 2] * 12))) for y in (2001, 2002)]
    df = spark.createDataFrame(rows, bundle.FILES).repartition(3)
    return df.selectExpr("file", "place", "CASE WHEN place LIKE '%2002%' THEN raise_error('lost') ELSE data END AS data") if broken else df


def manifest(world="observed", digest="x"):
    own = {"years": [2001, 2002], "thresholds": {"p90": [{"file": f"observed/p90/{y}-{y}", "first_year": y, "n_months": 12} for y in (2001, 2002)]}}
    return {"worlds": {world: own}, "cells": {"file": "cells", "n_cells": 2, "digest": digest}}


def held(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_a_bundle_is_read_as_it_was_written(spark, tmp_path):
    bundle.write(files(spark), str(tmp_path), manifest())
    m = bundle.read_manifest(str(tmp_path))
    assert bundle.named_files(m) | {"manifest.json", "grid.json"} == set(held(tmp_path)) and not [n for n in held(tmp_path) if bundle.STAGING in n]
    entry = m["worlds"]["observed"]["thresholds"]["p90"][0]
    assert entry["bytes"] == len(held(tmp_path)[entry["file"]]) and json.loads((tmp_path / "grid.json").read_text())["nlat"] == 721
    df = bundle.frames(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == 2
    rows = df.collect()
    assert len(rows) == 48 and {(r.cell_id, r.days) for r in rows} == {(5, 1), (9, 2)} and {(r.year, r.month) for r in rows} == {(y, k) for y in (2001, 2002) for k in range(1, 13)}


def test_a_failed_write_leaves_the_old_bundle_whole(spark, tmp_path):
    bundle.write(files(spark), str(tmp_path), manifest())
    before = held(tmp_path)
    with pytest.raises(Exception, match="lost"):
        bundle.write(files(spark, 7, broken=True), str(tmp_path), manifest())
    assert held(tmp_path) == before
    bundle.write(files(spark, 7), str(tmp_path), manifest())
    after = held(tmp_path)
    assert set(after) - {"manifest.json", "grid.json"} == bundle.named_files(json.loads(after["manifest.json"])) and {r.days for r in bundle.frames(spark, str(tmp_path)).collect()} == {7, 2}


def test_worlds_of_the_same_mask_stay(spark, tmp_path):
    bundle.write(files(spark), str(tmp_path), manifest("counterfactual"))
    bundle.write(files(spark), str(tmp_path), manifest("observed"))
    assert set(bundle.read_manifest(str(tmp_path))["worlds"]) == {"observed", "counterfactual"}
    bundle.write(files(spark), str(tmp_path), manifest("observed", "another"))
    assert set(bundle.read_manifest(str(tmp_path))["worlds"]) == {"observed"}


def test_digests_of_files_of_any_size(spark, tmp_path):
    import hashlib

    with open(tmp_path / "large.nc", "wb") as f:
        f.truncate(3 << 30)  # takes no room
    (tmp_path / "small.nc").write_bytes(b"abc")
    got = {r.path: (r.size, r.sha256) for r in listing.digests(spark, str(tmp_path)).collect()}
    zeros = hashlib.sha256()
    for _ in range(3 << 10):
        zeros.update(bytes(1 << 20))
    assert got == {"large.nc": (3 << 30, zeros.hexdigest()), "small.nc": (3, hashlib.sha256(b"abc").hexdigest())}
    assert listing.digests(spark, str(tmp_path)).rdd.getNumPartitions() == 2


def test_other_digests_are_refused(spark):
    page = {"_embedded": {"stash:files": [{"path": "a.nc", "size": 1, "digestType": "md5", "digest": "x", "_links": {"stash:download": {"href": "/a"}}}]}}
    with pytest.raises(Exception, match="a.nc: digests of kind md5"):
        listing.entries(spark.createDataFrame([(json.dumps(page),)], "json string"), "").collect()
