"""Benchmark decontamination by pigeonhole edit matching.

Documents and test items are compared as lower-case words with single spaces between. An item of m
characters may be found with k = ``ERRORS`` * m edits. It is split into k + 1 pieces: k edits leave one of
them whole, so an exact search for all pieces at once (an Aho-Corasick automaton) finds every place where
the item can be. The places' windows go to Myers' bit-parallel search, whose columns are single numbers.
Items of fewer than ``MIN_ITEM`` characters are searched with the spaces around them, so that they are found as whole
words; an edit of such a space counts like any other.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, unused

#: Edits allowed for each character of an item.
ERRORS = 0.08
#: Items with fewer characters in their words are searched with the spaces around them.
MIN_ITEM = 32
#: Characters of items that one automaton holds; more items are searched in blocks, each against all documents.
BLOCK_CHARS = 4_000_000

_words = re.compile(r"\w+").findall


def plain(text: str | None) -> str:
    return " ".join(_words((text or "").lower()))


def budget(item: str) -> int:
    return math.floor(ERRORS * len(item))


def searched(item: str) -> str:
    """What is searched for: an item, a short one with the spaces around it."""
    return item if len(item) >= MIN_ITEM else f" {item} "


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget plus one pieces of what is searched for, as even as can be."""
    n, whole = budget(item) + 1, searched(item)
    ends = [len(whole) * i // n for i in range(n + 1)]
    return [(a, whole[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def best_match(item: str, text: str) -> tuple[int, int]:
    """The least edit distance of the item to a part of the text, and where the first such part ends (Myers 1999)."""
    m, at = len(item), {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = at.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = (minus | ~(xh | plus)) & full
        down = plus & xh
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1, down << 1
        plus = (down | ~(xv | up)) & full
        minus = up & xv & full
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Searches texts for items: (item_id, plain text) pairs."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items, self.automaton, at = items, ahocorasick.Automaton(), {}
        for k, (_, item) in enumerate(items):
            for offset, piece in pieces(item):
                at.setdefault(piece, []).append((k, offset))
        for piece, uses in at.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the plain text) of every item within its budget, by item_id; the best place of each."""
        body = f" {plain(text)} "
        if len(body) == 2 or not self.items:
            return []
        spots: dict[int, set[int]] = {}
        for end, (size, uses) in self.automaton.iter(body):
            for k, offset in uses:
                spots.setdefault(k, set()).add(end + 1 - size - offset)
        found = []
        for k, starts in spots.items():
            name, item = self.items[k]
            whole, most = searched(item), budget(item)
            m, before = len(whole), 1 + (len(whole) - len(item)) // 2  # spaces that are no part of the item in the text
            exact = [s for s in starts if s >= 0 and body.startswith(whole, s)]
            if exact:
                found.append((name, 0, min(exact) + m - before))
                continue
            runs: list[list[int]] = []
            for s in sorted(starts) if most else ():
                low, high = max(0, s - most), s + m + most
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = high
                else:
                    runs.append([low, high])
            tried = [(d, low + e) for low, high in runs for d, e in [best_match(whole, body[low:high])]]
            d, e = min(tried, default=(most + 1, 0))
            if d <= most:
                found.append((name, d, min(e - before, len(body) - 2)))
        return sorted(found)


_matchers: dict[int, tuple[object, Matcher]] = {}


def _matcher(shared) -> Matcher:
    """One for each worker process and broadcast; the last few are kept."""
    items = shared.value
    key = id(items)
    if key not in _matchers or _matchers[key][0] is not items:
        if len(_matchers) >= 2:
            _matchers.clear()
        _matchers[key] = (items, Matcher(items))
    return _matchers[key][1]


def _blocks(benchmark: DataFrame) -> Iterator:
    """A broadcast of each block of the benchmark (item_id, text), of about BLOCK_CHARS; one is there at a time.

    Items that are null or without words match nothing, those shorter than ``MIN_ITEM`` only as whole words; of equal ids each text is an item of its own, and equal rows are one.
    """
    spark = benchmark.sparkSession
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        shared = spark.sparkContext.broadcast([(r.item_id, p) for r in rows if (p := plain(r.text))])
        yield shared, blocks > 1
        if blocks > 1:
            shared.destroy()


def _search(shared):
    @F.pandas_udf("array<struct<item_id:long,distance:int,ends_at:int>>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = _matcher(shared)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "distance", "ends_at"), x, strict=True)) for x in matcher.find(t)] for t in texts], dtype=object)

    return search.asNondeterministic()  # or a filter on what it finds would search again


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, distance, ends_at (characters into the document's plain words).

    Null and empty texts have none; repeated rows give repeated rows; columns other than doc_id and text are left out.
    A benchmark of several blocks is searched for a block at a time, and what is found is kept in the checkpoint folder.
    """
    found = None
    for shared, several in _blocks(benchmark):
        part = docs.select("doc_id", F.explode(_search(shared)("text")).alias("leak")).select("doc_id", "leak.*")
        part = cut(part) if several else part
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no item is found; each block of the benchmark searches what is left."""
    name, columns = unused("leaks", docs), docs.columns
    for shared, several in _blocks(benchmark):
        docs = docs.withColumn(name, _search(shared)("text")).where(F.size(name) == 0).select(*columns)
        docs = cut(docs) if several else docs
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
