"""Hard negatives for contrastive training, by blocked dense products.

Vectors are quantised to whole numbers, so an inner product is exact in double precision below 2**53 (and in
whole numbers beyond). Anchors are dealt into blocks of about ``BLOCK``; each block is broadcast and multiplied
with the candidates, a tile at a time, twice: the first pass keeps every anchor's best rows of its own label,
the second, for each anchor and positive, the best rows of other labels whose score lies in a window that the
positive's score opens. A task hands on no more than the best few of its own rows, and the best of several tasks
are the best of all: what is kept merges in any order, so that no pair of rows is ever a row itself.

Nulls and odd rows: rows without an id or label, and those whose vector is null or holds a null or a component
that is not finite, take no part; nor do rows with components so large that a score might not fit 57 bits (beyond
some 130,000 in size, in 64 dimensions). Vectors of different lengths never meet. A row is no partner of anchors
that have its id, and rows that share an id and the score are one. Vectors without components score zero.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut, table

#: Anchors of a block, about: with 64 dimensions a megabyte is broadcast.
BLOCK = 2_048
#: Candidates that are multiplied at a time.
TILE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of negatives, in hundredths of the positive's score.
LOW, HIGH = 30, 90
SCALE = 256
#: What a row's own share of a score may be at most, squared: a product stays below 2**56.
_MOST = 2**56
_NONE, _LAST = -(2**63 - 1), 2**63 - 1


@dataclass
class Best:
    """The best k of each of n: scores in descending order with the ids that have them; of equal scores smaller ids come first."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, n: int, k: int) -> Best:
        return cls(np.full((n, k), _NONE, np.int64), np.full((n, k), _LAST, np.int64))

    def absorb(self, scores: np.ndarray, ids: np.ndarray, eligible: np.ndarray) -> None:
        """Takes in the eligible ones of scores (n, m), which the rows ids (m) have."""
        k = self.scores.shape[1]
        last, who = self.scores[:, -1:], self.ids[:, -1:]
        take = eligible & ((scores > last) | ((scores == last) & (ids < who)))
        if len(ids) > k and take.sum() > 4 * take.shape[0] * k and len(np.unique(ids)) == len(ids):
            least = np.partition(np.where(take, scores, _NONE), -k, axis=1)[:, -k]  # the k-th best of the tile alone
            take &= scores >= least[:, None]
        rows, cols = np.nonzero(take)
        if not len(rows):
            return
        touched = np.unique(rows)
        r = np.concatenate([rows, np.repeat(touched, k)])
        s = np.concatenate([scores[rows, cols].astype(np.int64), self.scores[touched].ravel()])
        i = np.concatenate([ids[cols], self.ids[touched].ravel()])
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])])
        r, s, i = r[new], s[new], i[new]
        starts = np.searchsorted(r, touched)
        place = np.arange(len(r)) - np.repeat(starts, np.diff(np.append(starts, len(r))))
        kept = place < k
        self.scores[touched], self.ids[touched] = _NONE, _LAST
        self.scores[r[kept], place[kept]], self.ids[r[kept], place[kept]] = s[kept], i[kept]


@dataclass
class Block:
    """Anchors of one length of vectors; number is an anchor's place in its whole block."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two lots of whole-number vectors, exact."""
    if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2.0**53:
        return a @ b.T
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _tiles(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of a batch's rows with vectors of this length, TILE at a time."""
    ids, labels, vectors = (batch.column(name) for name in ("vec_id", "label", "q"))
    sizes = np.diff(vectors.offsets.to_numpy())
    of = np.nonzero(sizes == length)[0]
    flat = vectors.flatten().to_numpy().astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    ids, labels = ids.to_numpy(), labels.to_numpy()
    for k in range(0, len(of), TILE):
        some = of[k : k + TILE]
        yield ids[some], labels[some], flat[starts[some][:, None] + np.arange(length)]


def _positives(blocks) -> Callable:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best.of(len(b.ids), POSITIVES) for b in blocks.value]
        for batch in batches:
            for b, top in zip(blocks.value, kept, strict=True):
                for ids, labels, vectors in _tiles(batch, b.vectors.shape[1]):
                    top.absorb(products(b.vectors, vectors), ids, (b.labels[:, None] == labels) & (b.ids[:, None] != ids))
        for b, top in zip(blocks.value, kept, strict=True):
            yield _rows(b.number, top)

    return best


def _negatives(blocks, windows) -> Callable:
    """windows: per block, the anchors (places in the block), numbers, and lowest and highest scores of its pairs."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best.of(len(at), NEGATIVES) for at, *_ in windows.value]
        for batch in batches:
            for b, (at, _, low, high), top in zip(blocks.value, windows.value, kept, strict=True):
                for ids, labels, vectors in _tiles(batch, b.vectors.shape[1]):
                    scores = products(b.vectors, vectors)
                    other = (b.labels[:, None] != labels) & (b.ids[:, None] != ids)
                    scores = scores[at]
                    top.absorb(scores, ids, other[at] & (scores >= low[:, None]) & (scores <= high[:, None]))
        for (_, number, *_), top in zip(windows.value, kept, strict=True):
            yield _rows(number, top)

    return best


def _rows(number: np.ndarray, top: Best) -> pa.RecordBatch:
    filled = top.scores != _NONE
    numbers = np.broadcast_to(number[:, None], filled.shape)[filled].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(top.scores[filled]), pa.array(top.ids[filled])], ["number", "score", "id"])


def _first(found: DataFrame, k: int) -> list:
    """The best k of every number: (number, rank, score, id), at most k for each of a block's numbers."""
    order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect()


def _quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == math.inf))
    good = rows.select("vec_id", "label", "embedding").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    size = F.coalesce(F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(x.cast("double") * SCALE).cast("double")))), F.lit(0.0))
    return good.where(size * size * F.size("embedding") <= float(_MOST)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("q"))


def _blocks(anchors: list) -> list[Block]:
    lengths = sorted({len(r.q) for r in anchors})
    out = []
    for d in lengths:
        own = [(k, r) for k, r in enumerate(anchors) if len(r.q) == d]
        vectors = np.array([r.q for _, r in own], np.float64).reshape(len(own), d)
        out.append(Block(np.array([k for k, _ in own]), np.array([r.vec_id for _, r in own]), np.array([r.label for _, r in own]), vectors))
    return out


def _windows(blocks: list[Block], positives: list) -> tuple[list, list]:
    """What _negatives takes, and the pairs by their numbers: (anchor's number, positive's score and id)."""
    of = {}
    for r in sorted(positives):
        of.setdefault(r.number, []).append(r)
    pairs, out = [], []
    for b in blocks:
        own = [(k, r) for k, n in enumerate(b.number.tolist()) for r in of.get(n, [])]
        score = np.array([r.score for _, r in own], np.int64)
        number = np.arange(len(pairs), len(pairs) + len(own))
        out.append((np.array([k for k, _ in own], np.int64), number, -(-LOW * score // 100), HIGH * score // 100))
        pairs += [(r.number, r.score, r.id) for _, r in own]
    return out, pairs


def hard_negatives(rows: DataFrame, anchor: Column) -> DataFrame:
    """Per anchor, positive and rank: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows has (vec_id, label, embedding); anchor, a condition on vec_id and label, says which rows are anchors. An
    anchor's positives are its first POSITIVES other rows of its label, by descending score and then by id; a pair's
    negatives are the first NEGATIVES rows of other labels with a score of LOW to HIGH hundredths of the positive's.
    Of anchors that are alike in id, label and vector one is searched for. Results are written to the checkpoint
    folder a block at a time, and stay there.
    """
    spark = rows.sparkSession
    sc, folder = spark.sparkContext, f"{checkpoint_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    rows = _quantised(rows)
    anchors = cut(rows.where(anchor).distinct())
    parts = max(1, -(-anchors.count() // BLOCK))
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], names).write.parquet(folder)
    for part in range(parts):
        block = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(parts)) == part).collect()  # about BLOCK rows
        if not block:
            continue
        blocks = _blocks(block)
        sent = sc.broadcast(blocks)
        positives = _first(rows.mapInArrow(_positives(sent), "number int, score long, id long"), POSITIVES)
        windows, pairs = _windows(blocks, positives)
        opened = sc.broadcast(windows)
        negatives = _first(rows.mapInArrow(_negatives(sent, opened), "number int, score long, id long"), NEGATIVES)
        found = [(block[pairs[r.number][0]].vec_id, pairs[r.number][2], r.rank, r.id, pairs[r.number][1], r.score) for r in negatives]
        if found:
            columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            spark.createDataFrame(pd.DataFrame(found, columns=columns), names).write.mode("append").parquet(folder)
        sent.destroy()
        opened.destroy()
    return spark.read.schema(names).parquet(folder)


def relabelled(rows: DataFrame) -> DataFrame:
    """rows, of which those with an id divisible by 7 have the next label of ten."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


ORACLE_SQL = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({SCALE} * x)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM scored WHERE same) WHERE k <= {POSITIVES}),
neg AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS k
  FROM pos p JOIN scored s USING (anchor_id) WHERE NOT s.same AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE k <= {NEGATIVES}
"""
