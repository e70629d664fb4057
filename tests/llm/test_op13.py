import math

import numpy as np
import pytest
from pyrelake.llm import op13_hard_negatives as op13
from pyspark.sql import functions as F


def brute(rows, every=100):
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(x)) for x in v)))
    out = []
    for i, label, q in sorted(set(good)):
        if i % every:
            continue
        scored = {(-sum(x * y for x, y in zip(q, p, strict=True)), j, own == label) for j, own, p in good if j != i and len(p) == len(q)}
        near = sorted((s, j) for s, j, same in scored if same)[:5]
        far = sorted((s, j) for s, j, same in scored if not same)
        for s, j in near:
            fits = [(t, k) for t, k in far if 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(fits, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


def mined(rows, every=100):
    return sorted(map(tuple, op13.hard_negatives(op13.relabelled(rows), F.col("vec_id") % every == 0).collect()))


@pytest.mark.parametrize(("d", "block", "tile"), [(16, 2048, 256), (3, 7, 11), (1, 5, 256)])
def test_matches_brute_force(spark, d, block, tile, monkeypatch):
    monkeypatch.setattr(op13, "BLOCK", block)
    rng = np.random.default_rng(d)
    rows = [(int(i), int(rng.integers(4)), np.round(rng.normal(size=d), 1).tolist()) for i in rng.permutation(400)]
    rows += [(1000 + k, int(k % 3), rows[0][2]) for k in range(60)]  # many copies, and ties
    assert mined(frame(spark, rows), 10) == brute(rows, 10)


def test_best_of_tiles_are_the_best_of_all():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 9, (6, 200)), rng.permutation(150)[rng.integers(0, 150, 200)]
    able = rng.random((6, 200)) < 0.7
    best = op13.Best.of(6, 5)
    for k in range(0, 200, 23):
        best.absorb(scores[:, k : k + 23].astype(float), ids[k : k + 23], able[:, k : k + 23])
    for n in range(6):
        wanted = sorted({(-int(s), int(i)) for s, i, a in zip(scores[n], ids, able[n], strict=True) if a})[:5]
        assert [(-s, i) for s, i in zip(best.scores[n].tolist(), best.ids[n].tolist(), strict=True)] == wanted


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(i % 3), (rng.integers(-(2**18), 2**18, 4) + rng.random(4)).tolist()) for i in range(120)]
    assert mined(frame(spark, rows), 10) == brute(rows, 10)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (100, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (100, 2, [0.5, 1.0]), (1, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (2, 1, None), (3, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]),
        (4, 1, [nan, 1.0]), (5, 2, [inf, 1.0]), (6, 2, [1.0, None]), (8, 2, [0.5, 0.5]), (8, 2, [0.4, 0.5]), (9, 3, []), (200, 3, []), (10, 4, []), (11, 1, [1.0, 2.0, 3.0]), (13, 2, [0.2, 0.4]), (300, 1, [-1.0, -1.0]),
    ]
    df = frame(spark, rows).withColumn("q", F.lit("x")).withColumn("number", F.lit(None).cast("int")).withColumn("score", F.lit(1.5)).withColumn("id", F.lit(7))
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []
    assert mined(frame(spark, [(100, 1, [1e30, 1.0]), (1, 1, [1.0, 1.0])])) == []


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op13.op13_hard_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)
