import zlib

import numpy as np
from pyrelake.llm.op1_quality import DEPTH, STATISTICS, grow, op1_quality, quality, statistics, train
from pyspark.sql import functions as F


def slow(forest, x):
    """One document and one tree at a time."""
    total = forest.prior
    for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
        at = 0
        for _ in range(DEPTH):
            at = 2 * at + (2 if x[f[at]] > t[at] else 1)
        total += v[at - (2**DEPTH - 1)]
    return 1 / (1 + np.exp(-total))


def test_flat_arrays_give_what_a_walk_down_each_tree_gives():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = grow(x, y)
    assert np.allclose(forest.scores(x[:50]), [slow(forest, r) for r in x[:50]])
    new = rng.normal(size=(500, 5))
    assert np.mean((forest.scores(new) > 0.5) == ((new[:, 0] > 0) ^ (new[:, 1] > 0.5))) > 0.93


def test_statistics_have_their_names():
    for t in (None, "", " ", "A b\nA b", "é|x!!", "\n\n"):
        assert len(statistics(t)) == len(STATISTICS) and np.isfinite(statistics(t)).all()


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op1_quality(spark, sf).collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[r.doc_id].score, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.97


def test_labels_of_held_out_rows_teach_nothing(spark, sf):
    from pyrelake.llm.common import held_out

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lied = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train(docs, labels), train(docs, lied)
    assert a.prior == b.prior and all((x == y).all() for x, y in ((a.feature, b.feature), (a.threshold, b.threshold), (a.value, b.value)))


def test_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality(odd_docs, train(odd_docs, none)).collect()
    assert len(rows) == odd_docs.count() and all(r.score == 0.5 for r in rows)
    odd = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (2, None, 1), (None, 1, 1), (6, 1, 0), (7, 1, 0), (99, 1, 1)], "doc_id long, quality int, text int")
    assert all(0 <= r.score <= 1 for r in quality(odd_docs, train(odd_docs, odd)).collect())
    assert quality(odd_docs.limit(0), train(odd_docs.limit(0), odd)).collect() == []
