"""Text quality by histogram gradient-boosted trees over document statistics.

Each text, whole, gives a row of statistics: its length, kinds of characters, words and how they repeat,
lines and how they repeat. Trees are grown here in numpy on quantile bins of a bounded labelled sample,
level by level from histograms of slopes and curvatures. The forest is flattened into arrays - a statistic
and a threshold for each inner node, a value for each leaf, every tree complete - so that a batch of
documents goes down all trees at once, one level a step.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, slices, table

#: Labelled documents that the forest learns from at most: those with the smallest hashed ids.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST, SHRINK = 80, 4, 64, 0.2, 5.0, 1.0
THRESHOLD = 0.3
STATISTICS = [
    "log_chars", "log_words", "word_length", "upper", "lower", "digits", "spaces", "sentence_marks", "other_marks", "bars", "high_bytes",
    "distinct_words", "top_word", "next_same", "distinct_pairs", "marked_words", "upper_words", "log_lines", "distinct_lines", "line_length", "short_lines",
]
_KIND = np.zeros(256, np.int64)
_KIND[128:] = 7
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:?'\"-()", b"!#$%&*+/<=>@[\\]^_`{}~", b"|")):
    _KIND[list(_chars)] = _k


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a text; zeros for null and empty ones."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_KIND, np.bincount(raw, minlength=256), 8) / len(raw)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    some = max(n, 1)
    return [
        np.log1p(len(text)), np.log1p(n), sum(map(len, words)) / some, *kinds[[0, 1, 2, 3, 4, 5, 6, 7]].tolist(),
        len(counts) / some, max(counts.values(), default=0) / some, sum(map(operator.eq, words, words[1:])) / some, len(pairs) / max(n - 1, 1),
        sum(n for w, n in counts.items() if w[-1] in "!#$%&*|~") / some, sum(n for w, n in counts.items() if w.isupper() and len(w) > 1) / some,
        np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), len(text) / max(len(lines), 1), sum(len(x) < 20 for x in lines) / max(len(lines), 1),
    ]


@dataclass
class Forest:
    """prior: the score's log odds before any tree; feature and threshold (trees, 2**DEPTH - 1); value (trees, 2**DEPTH)."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        trees = np.arange(len(self.value))
        rows = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        total = self.prior + self.value[trees, at - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Fits x (n, statistics) to labels y of 0 and 1. With no rows every score is a half; with labels of one kind, nearly that label."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    prior, inner = float(np.log(share / (1 - share))), 2**DEPTH - 1
    if n == 0 or y.min() == y.max():
        return Forest(prior, np.zeros((1, inner), np.int64), np.zeros((1, inner)), np.zeros((1, inner + 1)))
    x = np.asarray(x, np.float64)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    width, m = BINS, x.shape[1]
    offsets = np.arange(m) * width
    flat = bins + offsets
    feature, threshold, value = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    score = np.full(n, prior)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            where = ((node - first)[:, None] * (m * width) + flat).reshape(-1)
            g, h = (np.bincount(where, np.repeat(v, m), count * m * width).reshape(count, m, width) for v in (slope, curve))
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gr, hr = gt - gl, ht - hl
            gain = np.where((hl >= LEAST / 4) & (hr >= LEAST / 4), gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK) - gt**2 / (ht + SHRINK), -np.inf).reshape(count, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > 1e-9
            f, b = best // width, best % width
            b = np.where(split, b, width)
            feature[t, first : first + count] = f
            threshold[t, first : first + count] = [edges[i][k] if k < len(edges[i]) else np.inf for i, k in zip(f, b, strict=True)]
            own = node - first
            node = 2 * node + 1 + (bins[np.arange(n), f[own]] > b[own])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
        value[t] = RATE * g / (h + SHRINK)
        score += value[t, leaf]
    return Forest(prior, feature, threshold, value)


def train(docs: DataFrame, labels: DataFrame) -> Forest:
    """A forest from labels (doc_id, quality) that are 0 or 1 and not held out, and the texts of their documents."""
    picked = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality"))
    picked = picked.where("doc_id IS NOT NULL")
    share = min(1.0, 2 * SAMPLE / max(1, picked.count()))  # so that tasks hold back few rows each
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = picked.where(ticket < int(share * (1 << 30))).orderBy(ticket, "doc_id", "quality").limit(SAMPLE)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most SAMPLE rows of two numbers
    rows = texts.select("doc_id", "quality", _statistics()("text").alias("x")).orderBy("doc_id", "quality").limit(2 * SAMPLE).collect()
    return grow(np.array([r.x for r in rows]).reshape(-1, len(STATISTICS)), np.array([r.quality for r in rows], np.float64))


def _statistics():
    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in slices(batches):
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    return of


def quality(docs: DataFrame, forest: Forest) -> DataFrame:
    """Per row of docs: doc_id, held_out, score and predicted. A null text scores like an empty one; other columns are left out."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in slices(batches):
            yield pd.Series(forest.scores(np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))))

    out = docs.select("doc_id", score("text").alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, train(docs, table(spark, sf_dir, "labels")))
