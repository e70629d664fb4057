import zlib

import numpy as np
import pytest
from pyrelake.llm import op11_toxicity as op11
from pyspark.sql import functions as F


def auc(score, label):
    good, bad = score[label == 0], score[label == 1]
    return np.mean([(bad > g).mean() + 0.5 * (bad == g).mean() for g in good])


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return op11.train(*tables)


def test_held_out_documents(spark, tables, model):
    docs, labels = tables
    out = op11.toxicity(docs, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    score, toxic = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    assert len(held) > 80 and auc(score, toxic) > 0.85
    assert (score[toxic == 0] >= 0.3).mean() < 0.1 and (score[toxic == 1] >= 0.3).mean() > 0.6


def test_labels_of_held_out_documents_change_nothing(spark, tables, model):
    docs, labels = tables
    other = labels.withColumn("toxic", F.when(op11.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = op11.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), other)
    assert again.lexicon.entries == model.lexicon.entries and np.allclose(again.classifier.weight, model.classifier.weight)


def test_lexicon_counts_by_brute_force(spark, tables, model):
    rows = op11.sample(*tables).collect()
    assert sorted({r.toxic for r in rows}) == [-1, 0, 1]
    known = [(r.toxic, {e for w in op11.word_counts(r.text) for e in op11.entries_of(w)}) for r in rows if r.toxic >= 0]
    bad, good = sum(t for t, _ in known), sum(1 - t for t, _ in known)
    sure = {}
    for e in {e for t, own in known if t for e in own}:
        t, c = sum(t for t, own in known if e in own) + 0.5, sum(1 - t for t, own in known if e in own) + 0.5
        if t >= 2.5 and t / (bad + 1) >= 4 * c / (good + 1):
            sure[e] = (np.log(t / (bad + 1 - t)) - np.log(c / (good + 1 - c))) / np.sqrt(1 / t + 1 / c)
    best = sorted(sure, key=lambda e: (-sure[e], e))[: op11.ENTRIES]
    assert np.allclose([sure[e] for e in best], [sure[e] for e in model.lexicon.entries]) and set(best[:300]) <= set(model.lexicon.entries)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(4)
    n, y = 6000, np.arange(6000) % 4 == 0
    right = [0.9, 0.8, 0.7, 0.6]
    cast = np.column_stack([np.where(rng.random(n) < 0.3, 0, np.where((rng.random(n) < p) == y, 1, -1)) for p in right] + [np.zeros((n, 3), int)])
    cast[:, 4:] = cast[:, [3]]  # three that repeat the worst voter
    label = np.where(rng.random(n) < 0.1, y, -1).astype(int)
    model = op11.label_model(cast.astype(np.int8), label)
    for k, p in enumerate(right):
        told = model.chance[1, k, 2] / (model.chance[1, k, 0] + model.chance[1, k, 2])
        assert abs(told - p) < 0.06
    assert model.correlation[3, 4] > 0.95 and model.correlation[0, 1] < 0.1
    hidden = label < 0
    guess = model.posterior(cast, np.full(n, -1))[hidden] > 0.5
    assert (guess == y[hidden]).mean() > 0.85  # as good as the best voters together, whatever the copies say


def test_linear_is_at_the_optimum():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2]
    q = 1 / (1 + np.exp(-(x @ [1.0, -0.3, 2.0] - 0.5)))
    found = op11.linear(x, q)
    z, p = x / found.spread, found.scores(x)
    assert np.abs(z.T @ (q - p) - op11.RIDGE * found.weight).max() < 1e-4 and abs((q - p).sum()) < 0.01


def test_odd_documents(spark, odd_docs, model):
    docs = odd_docs.withColumn("predicted", F.lit("x")).withColumn("toxic", F.lit(9))
    got = op11.toxicity(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[6]) == 1 and by[1] == by[2]
    assert op11.toxicity(docs.limit(0), model).collect() == []
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    for some in (labels, labels.where("toxic = 0"), labels.limit(0)):
        small = op11.train(docs, some)
        assert all(0 <= r.score <= 1 for r in op11.toxicity(docs, small).collect())
    assert op11.toxicity(docs, op11.train(docs.limit(0), labels.limit(0))).count() == docs.count()
