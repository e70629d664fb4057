"""Toxicity by weak supervision: many voters, a generative model of how they err, and a linear classifier of what they say.

Words, and beginnings of words, that stand in toxic documents of a bounded labelled sample far more often than in
others form a lexicon. Voters are read off it and off patterns of the text: each of the strongest entries, groups of
entries by kind and strength at several counts and shares, shouting and marks, and voters for clean texts where
entries are missing. Voters vote on labelled and on unlabelled documents of the sample.

The label model has a hidden class for each document and, for every voter, the chances of its votes in either class
(its accuracy); what two voters share within a class beyond that is their correlation. Both are estimated by expectation
and maximisation, where annotated documents keep the annotation's class. A vote counts for its log odds, divided by one plus
its correlations with the voters that vote beside it, so that twenty voters that read one word do not count twenty times,
and the sum is calibrated on the annotated documents. The posterior of each document, its annotation included, is the label that a logistic regression on lexicon counts and shares is fitted to; it alone scores documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, slices, table, unused

#: Documents that are learned from at most: labelled ones, and unlabelled ones that the voters label. Smallest hashed ids first.
SAMPLE, UNLABELLED = 16_000, 4_000
#: Entries of the lexicon at most, and those that are voters of their own.
ENTRIES, SINGLE = 600, 100
#: Lengths of the beginnings of longer words that are entries.
STEMS = (4, 5, 6, 7, 8)
#: An entry's share of toxic documents is at least so many times that of others, in at least so many toxic documents.
RATIO, SUPPORT = 4.0, 2
#: Where the entries, from the strongest, are parted into three strengths.
TIERS = (0.05, 0.25)
#: How often an annotation is right.
TRUST = 0.99
ROUNDS, RIDGE, LEAST_SPREAD = 30, 1.0, 0.05
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def entries_of(word: str) -> list[str]:
    """The lexicon entries that a word has part in: itself, and its beginnings."""
    return ["=" + word, *[word[:k] for k in STEMS if len(word) > k]]


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def patterns(text: str | None) -> list[float]:
    """Shares that need no lexicon: upper-case letters, exclamation marks, symbols, the most frequent word."""
    text = text or ""
    n, words = max(1, len(text)), word_counts(text)
    upper = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    return [upper / n, text.count("!") / n, sum(map(text.count, "#$%&*@")) / n, max(words.values(), default=0) / max(1, sum(words.values()))]


@dataclass
class Lexicon:
    """entries, strongest first; group is 3 * kind (0 a word, 1 a beginning) + strength (0 the strongest)."""

    entries: list[str]
    group: np.ndarray

    GROUPS = 6

    @classmethod
    def of(cls, entries: list[str]) -> Lexicon:
        ranks = np.arange(len(entries)) / max(1, len(entries))
        kinds = np.array([not e.startswith("=") for e in entries], np.int64)
        return cls(entries, 3 * kinds + np.searchsorted(TIERS, ranks, side="right"))

    def hits(self, text: str | None, of: dict[str, int], starts: set[str]) -> tuple[dict[int, int], int]:
        """The counts of the entries that text has, and its number of words; of gives an entry's place, starts their first two letters."""
        words, found = word_counts(text), {}
        for word, n in words.items():
            if word[:2] in starts:
                for e in entries_of(word):
                    k = of.get(e)
                    if k is not None:
                        found[k] = found.get(k, 0) + n
        return found, sum(words.values())

    def index(self) -> tuple[dict[str, int], set[str]]:
        return {e: k for k, e in enumerate(self.entries)}, {e.lstrip("=")[:2] for e in self.entries}


def features(lexicon: Lexicon, hits: list[dict[int, int]], n_words: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """A row a text: log counts of entries, log counts and shares of groups, patterns and length."""
    counts = np.zeros((len(hits), len(lexicon.entries)))
    for row, found in enumerate(hits):
        counts[row, list(found)] = list(found.values())
    sums = counts @ np.eye(Lexicon.GROUPS)[lexicon.group]
    return np.hstack([np.log1p(counts), np.log1p(sums), np.sqrt(sums / (n_words[:, None] + 10)), shares, np.log1p(n_words)[:, None]])


def votes(lexicon: Lexicon, hits: list[dict[int, int]], n_words: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """A row a document, a column a voter: 1 toxic, -1 clean, 0 no vote."""
    sums = np.zeros((len(hits), Lexicon.GROUPS))
    single = np.zeros((len(hits), min(SINGLE, len(lexicon.entries))), np.int8)
    for row, found in enumerate(hits):
        for k, n in found.items():
            sums[row, lexicon.group[k]] += n
            if k < single.shape[1]:
                single[row, k] = 1
    rates, rows = sums / (n_words[:, None] + 1), [single]
    rows += [(sums >= k).astype(np.int8) for k in (1, 2, 4)]
    rows += [(rates >= r).astype(np.int8) for r in (0.002, 0.01, 0.04)]
    rows.append((shares >= np.array([0.3, 0.02, 0.1, 0.3])).astype(np.int8))
    words, stems = sums[:, :3], sums[:, 3:]
    clean = [sums.sum(axis=1) == 0, words.sum(axis=1) == 0, stems.sum(axis=1) == 0, words[:, 0] + stems[:, 0] == 0, rates.sum(axis=1) < 0.002, n_words == 0]
    rows.append(-np.column_stack(clean).astype(np.int8))
    return np.hstack(rows)


@dataclass
class LabelModel:
    """chance (2, voters, 3): of votes -1, 0, 1 in a clean and a toxic document; correlation (voters, voters); scale and bias of the sum of evidence."""

    chance: np.ndarray
    correlation: np.ndarray
    scale: float
    bias: float

    def evidence(self, cast: np.ndarray) -> np.ndarray:
        """The sum of the votes' log odds, each divided by one plus its correlations with the other voters that vote."""
        at, active = cast.astype(np.int64) + 1, (cast != 0).astype(np.float64)
        odds = np.log(self.chance[1]) - np.log(self.chance[0])
        return (odds[np.arange(cast.shape[1]), at] * active / (1 + active @ self.correlation)).sum(axis=1)

    def posterior(self, cast: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The chance that a document with these votes, and this annotation if it is not -1, is toxic."""
        told = math.log(TRUST / (1 - TRUST)) * np.where(label < 0, 0, np.where(label > 0, 1, -1))
        return _logistic(self.scale * self.evidence(cast) + self.bias + told)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _calibrated(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """The scale and bias at which evidence tells toxic from other documents best, by Newton steps."""
    z, w = np.column_stack([evidence, np.ones(len(evidence))]), np.array([0.5, 0.0])
    for _ in range(25):
        p = _logistic(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2), z.T @ (toxic - p) - 1e-2 * w)
        w = w + step * min(1.0, 4 / max(np.abs(z @ step).max(initial=0), 1e-9))
    return float(max(w[0], 0.0)), float(w[1])


def label_model(cast: np.ndarray, label: np.ndarray) -> LabelModel:
    """Fits the model to votes and annotations (-1: none). An annotated document's class is the annotation's, the others' is hidden."""
    n, m = cast.shape
    one_hot = np.stack([cast == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    x, known = cast.astype(np.float64), label >= 0
    q, model = np.where(known, np.where(label > 0, TRUST, 1 - TRUST), (label[known].sum() + 1) / (known.sum() + 2)), None
    for _ in range(ROUNDS):
        chance, within = np.empty((2, m, 3)), np.zeros((m, m))
        for y, w in enumerate((1 - q, q)):
            chance[y] = (np.tensordot(w, one_hot, 1) + np.array([0.1, 0.8, 0.1])) / (w.sum() + 1)
            centred = x - (w @ x) / max(w.sum(), 1e-9)
            within += (centred * w[:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
        correlation = np.clip(within / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(correlation, 0)
        model = LabelModel(chance, correlation, 1.0, 0.0)
        model.scale, model.bias = _calibrated(model.evidence(cast[known]), (label[known] > 0).astype(np.float64))
        new = np.where(known, q, model.posterior(cast, label))
        if np.abs(new - q).max(initial=0) < 1e-4:
            break
        q = new
    return model


@dataclass
class Linear:
    weight: np.ndarray
    bias: float
    spread: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic((x / self.spread) @ self.weight + self.bias)


def linear(x: np.ndarray, q: np.ndarray) -> Linear:
    """Logistic regression of posteriors q on rows x, by Newton steps. Without rows every score is near a half."""
    spread = np.maximum(x.std(axis=0) if len(x) else np.ones(x.shape[1]), LEAST_SPREAD)
    z = np.hstack([x / spread, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], RIDGE), 1e-3)
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = _logistic(z @ w)
        slope = z.T @ (q - p) - penalty * w
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 8 / max(np.abs(z @ step).max(initial=0), 1e-9))  # no score moves by more than eight log odds a step
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Linear(w[:-1], float(w[-1]), spread)


@dataclass
class Model:
    lexicon: Lexicon
    labels: LabelModel
    classifier: Linear


def _chosen(rows: DataFrame, most: int) -> DataFrame:
    """The rows with the smallest hashed ids, about most at most, without ordering all of them."""
    share = min(1.0, 2 * most / max(1, rows.count()))  # so that tasks hold back few rows each
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    return rows.where(ticket < int(share * (1 << 30))).orderBy(ticket, *rows.columns).limit(most)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text) of the documents to learn from; toxic is -1 where no label was taken."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = cut(_chosen(known, SAMPLE))
    others = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    others = _chosen(others, UNLABELLED).join(F.broadcast(known.select("doc_id").distinct()), "doc_id", "left_anti")
    picked = cut(known.unionByName(others.select("doc_id", F.lit(-1).alias("toxic"))))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most 20,000 rows of two numbers
    return cut(texts.select("toxic", "text", F.xxhash64("doc_id", "text").alias("ticket")).orderBy("ticket", "toxic").limit(2 * (SAMPLE + UNLABELLED)))


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and other documents of a part have each entry."""
    for batch in batches:
        for k in range(0, len(batch), 250):
            part, counts = batch.iloc[k : k + 250], ({}, {})
            for toxic, text in zip(part["toxic"], part["text"], strict=True):
                own = {e for w in word_counts(text) for e in entries_of(w)}
                of = counts[toxic > 0]
                for e in own:
                    of[e] = of.get(e, 0) + 1
            names = list(counts[0].keys() | counts[1].keys())
            yield pd.DataFrame({"entry": names, "clean": [counts[0].get(e, 0) for e in names], "toxic": [counts[1].get(e, 0) for e in names]})


def mine(rows: DataFrame) -> Lexicon:
    """The entries that tell toxic from other documents of rows (toxic, text) most surely."""
    rows = rows.where("toxic >= 0")
    n = rows.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).first()
    bad, good = n.toxic or 0, n["all"] - (n.toxic or 0)
    seen = rows.select("toxic", "text").mapInPandas(_seen, "entry string, clean long, toxic long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (bad + 1.0 - t)) - F.log(c / (good + 1.0 - c))
    seen = seen.where((F.col("toxic") >= SUPPORT) & (t / (bad + 1.0) >= RATIO * c / (good + 1.0)))
    best = seen.select("entry", (odds / F.sqrt(1 / t + 1 / c)).alias("sure")).orderBy(F.desc("sure"), "entry").limit(ENTRIES).collect()
    return Lexicon.of([r.entry for r in best])


def _read(lexicon: Lexicon):
    """A column function: text -> the places and counts of its entries, its number of words, and its patterns."""

    @F.pandas_udf("struct<places:array<int>,counts:array<int>,n_words:long,shares:array<double>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of, starts = lexicon.index()
        for texts in slices(batches):
            found = [lexicon.hits(t, of, starts) for t in texts]
            yield pd.DataFrame({"places": [list(h) for h, _ in found], "counts": [list(h.values()) for h, _ in found], "n_words": [n for _, n in found], "shares": [patterns(t) for t in texts]})

    return read


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labels (doc_id, toxic) that are 0 or 1 and not held out, and the texts of the sample."""
    rows = sample(docs, labels)
    lexicon = mine(rows)
    got = rows.select("toxic", _read(lexicon)("text").alias("r")).select("toxic", "r.*").collect()
    hits = [dict(zip(r.places, r.counts, strict=True)) for r in got]
    n_words, label = np.array([r.n_words for r in got], np.float64), np.array([r.toxic for r in got], np.int64)
    shares = np.array([r.shares for r in got]).reshape(-1, 4)
    cast = votes(lexicon, hits, n_words, shares)
    model = label_model(cast, label)
    return Model(lexicon, model, linear(features(lexicon, hits, n_words, shares), model.posterior(cast, label)))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, score and predicted.

    Null, empty and wordless texts score like any text without entries; repeated rows score alike; other columns are left out.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, starts = model.lexicon.index()
        for texts in slices(batches):
            found = [model.lexicon.hits(t, of, starts) for t in texts]
            shares = np.array([patterns(t) for t in texts]).reshape(-1, 4)
            yield pd.Series(model.classifier.scores(features(model.lexicon, [h for h, _ in found], np.array([n for _, n in found], np.float64), shares)))

    name = unused("score", docs)
    out = docs.select("doc_id", score("text").alias(name))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"), (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
