"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are one class. Classes are parted by their leading principal coordinates, at the median of the
widest one by turns, into small leaves; neighbouring leaves make tiles of bounded size. A vector goes to the
tiles that hold a leaf near it: the leaf's box, which holds its vectors' coordinates and the norms of what is
left of them, is not too far from the vector's own for any link. Two tiles meet in a task with those vectors alone. There, the leading coordinates' products come first: with the products of the norms of what is left
they bound every cosine from above, in one matrix product, and pairs that cannot reach the threshold stop.
What is left gets the next coordinates, then the cosine in double precision. A task gives a row a vector
that is linked - how many vectors, and the least class it is connected to there - and never lists pairs.
The axes come from a bounded sample: any orthonormal axes give the same links, good ones stop earlier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, matched, table

THRESHOLD = 0.95
#: Vectors of a tile on average, bytes of a tile's vectors in double precision, and vectors of the blocks in which two tiles are compared.
TILE, TILE_BYTES, BLOCK = 8192, 64 << 20, 1024
#: Vectors that the axes and the leaves are fitted on, and the fewest of them that a leaf has.
SAMPLE, LEAST = 16384, 8
#: Coordinates that leaves are parted by; boxes have one more side, the norm of all other coordinates.
PARTED = 16
#: Leading coordinates taken first, and next.
LEADS = (16, 32)
#: What rounding may take off a bound in single precision.
SLACK = 1e-4


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def axes(sample: np.ndarray) -> np.ndarray:
    """(d, leads) principal axes about the origin, those with the most of the squared length first."""
    x = unit(sample)
    _, v = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(v[:, ::-1][:, : max(LEADS)])


def _leads(x: np.ndarray, basis: np.ndarray) -> list[np.ndarray]:
    """For each number of leads: those coordinates and the norm of all others, in single precision."""
    lead = x @ basis
    left = [np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", lead[:, :k], lead[:, :k]), 0)) for k in LEADS]
    return [np.column_stack([lead[:, :k], r]).astype(np.float32) for k, r in zip(LEADS, left, strict=True)]


def block_links(x: np.ndarray, y: np.ndarray, lx: list[np.ndarray], ly: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of x and y whose cosine reaches the threshold."""
    alive = lx[0] @ ly[0].T >= threshold - SLACK
    n = np.count_nonzero(alive)
    if not n:
        return (np.empty(0, np.int64),) * 2
    if n > alive.size / 8:
        return np.nonzero(x @ y.T >= threshold)
    i, j = np.nonzero(alive)
    for a, b, least in ((lx[1], ly[1], threshold - SLACK), (x, y, threshold)):
        keep = np.concatenate([np.einsum("ij,ij->i", a[i[k : k + 65536]], b[j[k : k + 65536]]) >= least for k in range(0, len(i), 65536)] or [np.empty(0, bool)])
        i, j = i[keep], j[keep]
    return i, j


def join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """labels (each a smaller or equal place) after linking places i and j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        np.minimum.at(labels, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while not (labels[labels] == labels).all():
            labels = labels[labels]


def parted(lead: np.ndarray) -> list[tuple[int, float, int, int]]:
    """Nodes (axis, cut, left, right) of a tree over the sample's coordinates whose leaves hold few of it; leaves are (-1, 0, number, 0)."""
    nodes, work, leaves = [None], [(0, lead)], 0
    while work:
        at, x = work.pop()
        axis = int(np.argmax(np.ptp(x, axis=0))) if len(x) else 0
        cut_at = float(np.median(x[:, axis])) if len(x) else 0.0
        right = x[:, axis] > cut_at if len(x) else np.empty(0, bool)
        if len(x) <= 2 * LEAST or not right.any():
            nodes[at] = (-1, 0.0, leaves, 0)
            leaves += 1
            continue
        nodes[at] = (axis, cut_at, len(nodes), len(nodes) + 1)
        work += [(len(nodes), x[~right]), (len(nodes) + 1, x[right])]
        nodes += [None, None]
    return nodes


def leaf_of(nodes: list[tuple[int, float, int, int]], lead: np.ndarray) -> np.ndarray:
    """The leaf of each row of coordinates."""
    axis, cut_at, left, right = (np.array(c) for c in zip(*nodes, strict=True))
    at, rows = np.zeros(len(lead), np.int64), np.arange(len(lead))
    while (inner := axis[at] >= 0).any():
        go = lead[rows, axis[at]] > cut_at[at]
        at = np.where(inner, np.where(go, right[at], left[at]), at)
    return left[at]


def places(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The coordinates of unit vectors that leaves are parted by, and behind them the norm of all others: no farther apart than the vectors are."""
    lead = (x @ basis)[:, :PARTED]
    return np.column_stack([lead, np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", lead, lead), 0))])


def near_tiles(at: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, parts: np.ndarray, reach: float) -> list[np.ndarray]:
    """For each row of places, the tiles of all leaves whose boxes (low, high) lie within reach of it; a leaf's tiles are first, first + 1 and so on, as many as parts."""
    at, low, high = (np.ascontiguousarray(x.T, np.float32) for x in (at, low, high))
    far = np.zeros((at.shape[1], low.shape[1]), np.float32)
    for x, a, b in zip(at, low, high, strict=True):
        gap = x[:, None] - np.clip(x[:, None], a, b)
        far += np.multiply(gap, gap, out=gap)
    shared, start = np.unique(first, return_index=True)  # leaves that share a tile are next to each other
    hit = np.logical_or.reduceat(far <= reach * reach + SLACK, start, axis=1)
    hit, tiles = np.repeat(hit, parts[start], axis=1), np.concatenate([np.arange(f, f + p, dtype=np.int32) for f, p in zip(shared, parts[start], strict=True)])
    return [tiles[row] for row in hit]


def tiles_of(sizes: list[int], dims: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(first tile, number of tiles) of each leaf: leaves next to each other share a tile, a large one is dealt over several."""
    first, parts, at, held = [], [], -1, 0
    for k, (n, d) in enumerate(zip(sizes, dims, strict=True)):
        most = max(1, min(TILE, TILE_BYTES // (8 * d)))
        need = math.ceil(n / most)
        if not k or d != dims[k - 1] or held + n > most:
            at, held = at + 1, 0
        first.append(at)
        parts.append(need)
        at, held = at + need - 1, held + n if need == 1 else most
    return np.array(first), np.array(parts)


def _valid(vector) -> F.Column:
    x = lambda f: lambda v: f(v.cast("double"))
    finite = F.forall(vector, x(lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, x(lambda v: v != 0)), F.lit(False))


def _compare(bases: dict[int, np.ndarray], threshold: float):
    def compare(key, rows):
        side = rows["side"].to_numpy()
        order = np.argsort(side, kind="stable")
        first = int((side == 0).sum())
        d = rows["dim"][0].as_py()
        raw = rows["vec"].combine_chunks()
        x = unit(raw.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)[order])
        cls, n = rows["cls"].to_numpy()[order], rows["n"].to_numpy()[order]
        leads = _leads(x, bases[d])
        links, labels = np.zeros(len(x), np.int64), np.arange(len(x))
        own = key[0].as_py() == key[1].as_py()
        for a in range(0, first, BLOCK):
            for b in range(a if own else first, len(x), BLOCK):
                s, t = slice(a, min(a + BLOCK, first)), slice(b, b + BLOCK)
                i, j = block_links(x[s], x[t], [v[s] for v in leads], [v[t] for v in leads], threshold)
                if own and a == b:
                    i, j = i[i < j], j[i < j]
                i, j = i + a, j + b
                links += np.bincount(i, n[j], len(x)).astype(np.int64) + np.bincount(j, n[i], len(x)).astype(np.int64)
                labels = join_labels(labels, i, j)
        hit = links > 0
        return pa.table({"cls": pa.array(cls[hit], pa.int64()), "links": pa.array(links[hit], pa.int64()), "low": pa.array(cls[labels[hit]], pa.int64())})

    return compare


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of vectors (vec_id, embedding): vec_id, n_links, component_id and kept.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, nor do
    rows without an id or vectors of different lengths. Each row is a vector: repeated rows link with each
    other. A row without an id has no component and is not kept.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding").withColumn("ok", F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    keyed = rows.where("ok").select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    classes = keyed.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("embedding").alias("vec"))
    classes = cut(classes.select("h1", "h2", "node", "n", "vec", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("cls")))
    share = min(1.0, 2 * SAMPLE / max(1, classes.count()))  # so that tasks hold back few rows each
    ticket = F.pmod("h2", F.lit(1 << 30))
    taken = classes.where(ticket < int(share * (1 << 30))).select("dim", "vec", "h1", "h2").orderBy(ticket, "h1").limit(SAMPLE).toArrow()
    dims, vecs = taken["dim"].to_numpy(), taken["vec"]
    sample = {int(d): np.concatenate([np.asarray(v.flatten(), np.float64) for v in vecs.filter(pa.array(dims == d)).chunks]).reshape(-1, d) for d in np.unique(dims)}
    bases = {d: axes(v) for d, v in sample.items()}
    trees = {}
    for d in [r.dim for r in classes.select("dim").distinct().collect()]:
        if d not in bases:
            bases[d] = np.eye(d, min(d, max(LEADS)))
        trees[d] = parted(places(unit(sample[d]), bases[d])[:, :-1] if d in sample else np.empty((0, 1)))

    @F.pandas_udf("leaf int, lead array<double>")
    def place(vecs: pd.Series) -> pd.DataFrame:
        leaves, leads = np.zeros(len(vecs), np.int32), [None] * len(vecs)
        dims = vecs.map(len).to_numpy()
        for d in np.unique(dims):
            mine = np.nonzero(dims == d)[0]
            at = places(unit(np.array(vecs.iloc[mine].tolist())), bases[d])
            leaves[mine] = leaf_of(trees[d], at)
            for k, row in zip(mine, at, strict=True):
                leads[k] = row
        return pd.DataFrame({"leaf": leaves, "lead": leads})

    placed = cut(classes.select("cls", "n", "dim", "vec", place("vec").alias("at")).select("cls", "n", "dim", "vec", "at.leaf", "at.lead"))
    # the boxes that hold what lies in the leaves: rows as the sample bounds them
    sides = [f(F.get("lead", F.lit(k))).alias(f"{name}{k}") for name, f in (("low", F.min), ("high", F.max)) for k in range(PARTED + 1)]
    boxes = placed.groupBy("dim", "leaf").agg(F.count("*").alias("size"), *sides).orderBy("dim", "leaf").collect()
    if not boxes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))
    low, high = (np.array([[r[f"{name}{k}"] or 0.0 for k in range(PARTED + 1)] for r in boxes]) for name in ("low", "high"))
    first, parts = tiles_of([r["size"] for r in boxes], [r.dim for r in boxes])
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    dims = np.array([r.dim for r in boxes])

    @F.pandas_udf("array<int>")
    def others(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for dim, leads in batches:
            out = [None] * len(dim)
            for d in dim.unique():
                mine, of = np.nonzero((dim == d).to_numpy())[0], dims == d
                for some in np.array_split(mine, math.ceil(len(mine) / 256)):
                    at = np.array(leads.iloc[some].tolist())
                    sides = at.shape[1]  # as many as a short vector has
                    for k, tiles in zip(some, near_tiles(at, low[of, :sides], high[of, :sides], first[of], parts[of], reach), strict=True):
                        out[k] = tiles
            yield pd.Series(out, dtype=object)

    where = spark.createDataFrame([(r.dim, r.leaf, int(first[k]), int(parts[k])) for k, r in enumerate(boxes)], "dim int, leaf int, first int, parts int")
    tiled = placed.join(F.broadcast(where), ["dim", "leaf"]).select("cls", "n", "vec", "dim", "lead", (F.col("first") + F.pmod(F.xxhash64("cls"), "parts").cast("int")).alias("tile"))
    pairs = tiled.select("cls", "n", "vec", "dim", "tile", F.explode(others("dim", "lead")).alias("other"))
    seated = pairs.select("cls", "n", "vec", "dim", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), (F.col("tile") > F.col("other")).cast("int").alias("side"))
    found = cut(seated.groupBy("tile_a", "tile_b").applyInArrow(_compare(bases, threshold), "cls long, links long, low long"))
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("cls").alias("u"), F.col("low").alias("v")))
    named = cut(named.join(classes.select(F.col("cls").alias("node"), F.col("node").alias("id")), "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = matched(named, least, ["component"]).select(F.col("node").alias("cls"), "component_id")
    top = cut(classes.select("h1", "h2", "node", "n", "cls").join(linked, "cls", "left").join(named, "cls", "left"))
    top = top.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("component_id"))
    good = matched(keyed.select("vec_id", "h1", "h2"), top, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(u, w) AS (SELECT u, w FROM links UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
comp AS (SELECT u, least(u, min(w)) AS c FROM reach GROUP BY u),
deg AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(deg.n, 0) AS n_links, coalesce(comp.c, vec_id) AS component_id, coalesce(comp.c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN deg ON deg.u = vec_id LEFT JOIN comp ON comp.u = vec_id
"""
