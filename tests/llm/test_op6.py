import numpy as np
import pytest
from pyrelake.llm import op6_embeddings as op6
from pyspark.sql import functions as F


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links, name = [0] * len(good), [i for i, _ in good]
    edges = []
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                edges.append((a, b))
                links[a] += 1
                links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if name[a] != name[b]:
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    out = [(i, n, c, i == c) for (i, _), n, c in zip(good, links, name, strict=True)]
    ids = [i for i, _ in good]
    for i, _ in rows:
        if i in ids:
            ids.remove(i)
        else:
            out.append((i, 0, i, i is not None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("d", "tile"), [(64, 4096), (64, 60), (5, 40), (2, 9)])
def test_matches_brute_force(spark, d, tile, monkeypatch):
    monkeypatch.setattr(op6, "TILE", tile)
    monkeypatch.setattr(op6, "BLOCK", 32)
    rng = np.random.default_rng(d + tile)
    base = rng.normal(size=(40, d))
    rows = [(int(i), (base[i % 40] + rng.normal(size=d) * rng.choice([0, 0.05, 0.15, 0.3, 1])).tolist()) for i in rng.permutation(300)]
    rows += [(900 + k, (base[0] + 0.02 * rng.normal(size=d)).tolist()) for k in range(80)] + [(990 + k, base[1].tolist()) for k in range(60)]
    got = op6.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_leaves_are_parted_and_far_ones_do_not_meet():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.01, (200, 4)) for c in (-0.6, -0.2, 0.2, 0.6)])
    nodes = op6.parted(x)
    leaf = op6.leaf_of(nodes, x)
    n = leaf.max() + 1
    assert 50 <= n and max(np.bincount(leaf)) <= 16 and sorted(k[2] for k in nodes if k[0] < 0) == list(range(n))
    low, high = (np.array([f(x[leaf == k], axis=0) for k in range(n)]) for f in (np.min, np.max))
    near = op6.near_tiles(x, low, high, np.arange(n) * 2, np.full(n, 2), 0.1)
    for k in range(0, len(x), 7):
        close = set(leaf[np.sqrt(((x - x[k]) ** 2).sum(1)) <= 0.1])
        assert {2 * v + e for v in close for e in (0, 1)} <= set(near[k]) and len(near[k]) <= n // 2


def test_tiles(monkeypatch):
    monkeypatch.setattr(op6, "TILE", 10)
    first, parts = op6.tiles_of([3, 4, 4, 25, 2, 9, 1, 1], [8, 8, 8, 8, 8, 8, 8, 9])
    assert first.tolist() == [0, 0, 1, 2, 5, 6, 6, 7] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op6.op6_embeddings(spark, sf).collect()), key=str) == brute(rows)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1e300, 1e300]), (9, [1e-300, 1e-300]), (10, [1.0, 1.0, 0.0]), (None, [1.0, 1.0]), (11, [-0.0, 2.0]), (12, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(None).cast("long")).withColumn("cls", F.lit(1)).withColumn("n", F.lit("x"))
    assert sorted(map(tuple, op6.embedding_groups(df).collect()), key=str) == brute(rows)
    assert op6.embedding_groups(df.limit(0)).collect() == []
    assert [tuple(r) for r in op6.embedding_groups(df.where("vec_id = 3")).collect()] == [(3, 0, 3, True)]
