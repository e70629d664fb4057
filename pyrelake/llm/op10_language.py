"""Language identification by a convolutional network over bytes, trained here in numpy.

A text's UTF-8 bytes are cut into windows of a fixed length, all of them, the last padded with zeros. Each
byte has a small vector; filters of several widths slide over a window, the largest answer of each filter
is kept, and a softmax over these gives the languages' probabilities. A document's are the mean over its
windows, by bytes. Training takes a bounded sample: of each language the documents with the smallest hashes of id
and text, and of each of these some windows spread over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, slices, table

WINDOW, WIDTHS, FILTERS, VECTOR = 256, (2, 3, 4), 12, 8
#: Bounds of the training sample: documents of a language, and windows of a document.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 400, 8
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 7
#: Windows answered at once.
BLOCK = 512
UNKNOWN = "und"


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's windows (n, WINDOW) and the bytes in each."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    full = np.zeros(n * WINDOW, np.uint8)
    full[: len(raw)] = raw
    sizes = np.full(n, WINDOW, np.float64)
    sizes[-1] = len(raw) - (n - 1) * WINDOW
    return full.reshape(n, WINDOW), sizes


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Network:
    """vectors (256, VECTOR); filters, all as wide as the widest with zeros beyond their width; and the output layer."""

    languages: list[str]
    parts: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def wide(self) -> int:
        return max(WIDTHS)

    def start(self) -> None:
        rng, n = np.random.default_rng(SEED), FILTERS * len(WIDTHS)
        self.live = np.repeat(np.array([[w > k for w in WIDTHS for _ in range(FILTERS)] for k in range(self.wide)]), VECTOR, axis=0)
        self.parts = {
            "vectors": rng.normal(0, 0.5, (256, VECTOR)), "filters": rng.normal(0, 0.3, (self.wide * VECTOR, n)) * self.live, "bias": np.zeros(n),
            "out": rng.normal(0, 0.1, (n, len(self.languages))), "prior": np.zeros(len(self.languages)),
        }
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}

    def slid(self, wins: np.ndarray) -> np.ndarray:
        """What the filters see at each place: (n, WINDOW, wide * VECTOR); places past the end see zeros bytes."""
        padded = np.zeros((len(wins), WINDOW + self.wide - 1), np.uint8)
        padded[:, :WINDOW] = wins
        seen = self.parts["vectors"][padded]
        s = seen.strides
        return np.lib.stride_tricks.as_strided(seen, (len(wins), WINDOW, self.wide * VECTOR), (s[0], s[1], s[2]))

    def pooled(self, wins: np.ndarray) -> np.ndarray:
        seen = np.ascontiguousarray(self.slid(wins)).reshape(-1, self.wide * VECTOR)
        return (seen @ self.parts["filters"]).reshape(len(wins), WINDOW, -1).max(axis=1)

    def probabilities(self, wins: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(wins), BLOCK):
            top = np.maximum(self.pooled(wins[i : i + BLOCK]) + self.parts["bias"], 0)
            out.append(_softmax((top @ self.parts["out"] + self.parts["prior"]).astype(np.float64)))
        return np.concatenate(out)

    def fit(self, wins: np.ndarray, labels: np.ndarray) -> Network:
        """Adam on the cross-entropy; a filter's error goes to the place where it answered most."""
        self.start()
        rng, step = np.random.default_rng(SEED), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.parts.items()} for _ in range(2))
        for _ in range(EPOCHS):
            order = rng.permutation(len(wins))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                w, p = wins[pick], self.parts
                seen = np.ascontiguousarray(self.slid(w))
                answers = seen.reshape(-1, seen.shape[2]) @ p["filters"]
                answers = answers.reshape(len(w), WINDOW, -1)
                place = answers.argmax(axis=1)
                raw = np.take_along_axis(answers, place[:, None], 1)[:, 0] + p["bias"]
                top = np.maximum(raw, 0)
                wrong = _softmax(top @ p["out"] + p["prior"])
                wrong[np.arange(len(w)), labels[pick]] -= 1
                wrong /= len(w)
                back = (wrong @ p["out"].T) * (raw > 0)
                at_place = seen[np.arange(len(w))[:, None], place]  # (n, filters, wide * VECTOR)
                to_seen = (back[:, :, None] * p["filters"].T).reshape(len(w), -1, self.wide, VECTOR)
                spread = np.zeros_like(p["vectors"])
                padded = np.pad(w, ((0, 0), (0, self.wide - 1)))
                bytes_at = padded[np.arange(len(w))[:, None, None], place[:, :, None] + np.arange(self.wide)]
                np.add.at(spread, bytes_at.reshape(-1), to_seen.reshape(-1, VECTOR))
                slopes = {"vectors": spread, "filters": np.einsum("nf,nfd->df", back, at_place) * self.live, "bias": back.sum(0), "out": top.T @ wrong, "prior": wrong.sum(0)}
                step += 1
                for k, g in slopes.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    p[k] -= (RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts) -> list[tuple[str, float]]:
        """(language, probability) of each text; UNKNOWN and 0 for null, for texts without a letter, and if nothing was learned."""
        found, cut, sizes, spans = [], [], [], []
        for t in texts:
            if not self.languages or t is None or not any(map(str.isalpha, t)):
                spans.append(None)
                continue
            w, s = windows(t)
            spans.append((len(w), s.sum()))
            cut.append(w)
            sizes.append(s)
        if cut:
            weighted = np.concatenate([self.probabilities(w) * s[:, None] for w, s in _gathered(cut, sizes)])
            ends = np.cumsum([n for n, _ in filter(None, spans)])
            sums = np.add.reduceat(weighted, np.concatenate([[0], ends[:-1]]), axis=0)
        k = 0
        for span in spans:
            if span is None:
                found.append((UNKNOWN, 0.0))
                continue
            mean = sums[k] / span[1]
            found.append((self.languages[int(mean.argmax())], float(min(1.0, mean.max()))))
            k += 1
        return found


def _gathered(cut: list[np.ndarray], sizes: list[np.ndarray]):
    """The windows of many texts, some thousands at a time."""
    some, lens, n = [], [], 0
    for w, s in zip(cut, sizes, strict=True):
        some.append(w)
        lens.append(s)
        n += len(w)
        if n >= 4 * BLOCK:
            yield np.concatenate(some), np.concatenate(lens)
            some, lens, n = [], [], 0
    if some:
        yield np.concatenate(some), np.concatenate(lens)


def _spread():
    """A column function: text -> the windows that are learned from, all or SAMPLE_WINDOWS from its begin to its end."""

    @F.pandas_udf("binary")
    def spread(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in slices(batches):
            cuts = [windows(t)[0] for t in texts]
            yield pd.Series([w[np.unique(np.linspace(0, len(w) - 1, SAMPLE_WINDOWS).round().astype(int))].tobytes() for w in cuts])

    return spread


def train(docs: DataFrame) -> Network:
    """A network for the languages of docs (doc_id, text, lang), from rows that are not held out and have a language and a letter.

    Every language there is gets SAMPLE_DOCUMENTS documents, or all it has. Rows without an id and repeated ids are told
    apart by their texts; equal rows count once. The driver gets so many windows of each language: lang must be a label,
    not free text.
    """
    ticket = F.xxhash64("doc_id", "text")
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")).select("lang", ticket.alias("ticket"), "text")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.approx_count_distinct("ticket").alias("n")).collect()}
    if not counts:
        return Network([])
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2 * SAMPLE_DOCUMENTS / n)))])
    # the share leaves few rows to order, the window keeps each language's own limit
    some = labelled.where(F.pmod("ticket", F.lit(1 << 30)) / float(1 << 30) < share[F.col("lang")]).dropDuplicates(["lang", "ticket"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("ticket"))
    picked = some.withColumn("place", place).where(F.col("place") <= SAMPLE_DOCUMENTS).select("lang", "place", _spread()("text").alias("wins")).collect()
    names = sorted({r.lang for r in picked})
    picked = [(names.index(r.lang), np.frombuffer(r.wins, np.uint8).reshape(-1, WINDOW)) for r in sorted(picked, key=lambda r: (r.lang, r.place))]
    return Network(names).fit(np.concatenate([w for _, w in picked]), np.concatenate([np.full(len(w), k) for k, w in picked]))


def language(network: Network):
    """A column function: text -> struct(lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            yield pd.DataFrame(network.predict(texts), columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score. Other columns are left out, repeated rows stay, a null id is not held out."""
    return docs.select("doc_id", language(network)("text").alias("p")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
