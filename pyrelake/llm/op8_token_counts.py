"""Token counts under a unigram model, with one forward pass over a trie of distinct pre-tokens.

A pre-token is a chunk between white space with the mark of a word's start before it. Its tokens are the
pieces of the likeliest split; a piece's likelihood follows its rank in a public vocabulary (rank + 2 to the
power -1), and characters outside the vocabulary fall back to bytes. Scores are whole numbers (millionths of
a nat), so sums are exact; of equally likely splits the one with the fewest pieces counts.

The best score and count of a prefix do not depend on what follows. Distinct pre-tokens go into a trie, each
node's score is computed once from its ancestors', and a node where a pre-token ends keeps its count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import LONG, Kept
from .common import table

VOCABULARY, START = "piece_bpe_32k.model", "▁"
#: Cost of a byte of a character that has no piece, in nats.
BYTE_COST = 14.0
#: Nodes of one trie; more pre-tokens go into another.
NODES = 200_000


#: A piece's value is its score times this, less one: sums compare by score, then by fewest pieces, and hold both.
UNIT = 1 << 32


class Unigram:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        names.sort(key=lambda i: (-model.get_score(i), i))
        self.value = {model.id_to_piece(i): -round(1e6 * math.log(rank + 2)) * UNIT - 1 for rank, i in enumerate(names)}
        self.byte = -round(1e6 * BYTE_COST) * UNIT - 1
        #: Pieces by their prefixes: {character: node}, and the value of the piece that ends at a node under "".
        self.root: dict = {}
        for piece, value in self.value.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = value

    def spelt(self, c: str) -> int:
        """The value of a character by its bytes."""
        return len(c.encode("utf-8", "replace")) * self.byte


    def pieces(self, word: str) -> int:
        """The pieces of the best split of one word, without a trie."""
        best, under_way = 0, [(self.root, 0)]
        for c in word:
            before, best, longer = best, None, []
            for prefix, sum_ in under_way:
                if (prefix := prefix.get(c)) is not None:
                    longer.append((prefix, sum_))
                    if (value := prefix.get("")) is not None and (best is None or sum_ + value > best):
                        best = sum_ + value
            if c not in self.value and (best is None or before + self.spelt(c) > best):
                best = before + self.spelt(c)
            under_way = [*longer, (self.root, best)]
        return -best % UNIT


class Trie:
    """Distinct pre-tokens by their shared prefixes."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w  # a terminal

    def counts(self, model: Unigram) -> dict[str, int]:
        """The pieces of each pre-token's best split: every node's best sum once, from those where its last piece can begin."""
        out: dict[str, int] = {}
        begin, values = model.root, model.value
        # a node's character, itself, the best sum before it, and (piece prefix, best sum where it began) of the pieces under way
        stack = [(c, node, 0, [(begin, 0)]) for c, node in self.root.items() if c]
        if "" in self.root:
            out[""] = 0
        while stack:
            c, node, before, under_way = stack.pop()
            best, longer = None, []
            for prefix, sum_ in under_way:
                if (prefix := prefix.get(c)) is not None:
                    longer.append((prefix, sum_))
                    if (value := prefix.get("")) is not None and (best is None or sum_ + value > best):
                        best = sum_ + value
            if c not in values and (best is None or before + model.spelt(c) > best):
                best = before + model.spelt(c)
            longer.append((begin, best))
            for key, below in node.items():
                if key:
                    stack.append((key, below, best, longer))
                else:
                    out[below] = -best % UNIT
        return out


@cache
def _kept(path: str) -> Kept:
    model = Unigram(path)

    def make(new: list[str]) -> list[int]:
        counts: dict[str, int] = {}
        some, size = [], 0
        for w in new:
            if len(w) > LONG:  # shares little, and would be a node a character
                counts[START + w] = model.pieces(START + w)
                continue
            some.append(START + w)
            size += len(w)
            if size >= NODES:
                counts |= Trie(some).counts(model)
                some, size = [], 0
        if some:
            counts |= Trie(some).counts(model)
        return [counts[START + w] for w in new]

    return Kept(make)


def counted(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Per row of docs: doc_id, n_words (pre-tokens) and n_tokens; zeros for null and empty texts. Repeated rows stay, other columns go."""

    @F.pandas_udf("n_words long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        kept = _kept(public_tokenizers.path(name))
        try:
            for texts in batches:
                yield pd.DataFrame([(len(found), sum(found)) for found in kept.of(texts)], columns=["n_words", "n_tokens"])
        finally:
            kept.forget()

    return docs.select("doc_id", count("text").alias("n")).select("doc_id", "n.*")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"))
