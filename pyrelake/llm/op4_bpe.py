"""BPE encoding and decoding with a token automaton compiled merge by merge.

The automaton reads tokens: its states are the tokens last read, and it has an arc from s to t if and only
if byte-pair merging leaves s followed by t as they are. It starts with one state in which every symbol may
follow every other. Merges are added in order; the gadget of a merge (u, v) -> w gives a new arc label w
wherever u could be read and then v, and takes the arc v from the states that reading u leads to. Splitting
those states one by one would end with a row of 49,000 arcs for each of 49,000 tokens. So a gadget is kept
as what it adds: the two labels that w stands for and its rank. Whether an arc is left is read off the
gadgets: going back in rank, the right end of s and the left end of t unfold to the labels they had at that
time, and the arc is gone if a merge of just these two came while both were there (of equal merges the leftmost is first). Answers are kept in a
transition table that grows with the arcs in use, up to a bound.

A word has one path that spells it. From each state the longest label that the symbols go on with and for which
there is an arc is taken, looked up by its bytes; where there is none, the last arc is undone and
the next shorter label tried. A prefix of a word has one path as well, so a place that led nowhere is not
tried again. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import LONG, Kept
from .common import give_back, slices, table

VOCABULARY = "word_bpe_49k.json"
#: Characters below it were assigned long ago.
LATER = "\u0558"
#: Arcs kept by a worker at most.
ARCS = 200_000
#: Words whose path a worker keeps at most.
WORDS = 100_000
#: Chunks in each generation that a worker keeps, and one beside other stages' idle workers.
KEPT_ALONE, KEPT_BESIDE = 250_000, 60_000
#: Stands behind the bytes of what ends a word; UTF-8 never has it.
END = b"\xff"


def vocabulary(name: str = VOCABULARY) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible, else the next free above 255."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in seen}
    return [names.setdefault(b, chr(256 + b - sum(x < b for x in seen))) for b in range(256)]


def _later_characters(tokenizer) -> str:
    """Characters that the pattern library knows as letters or numbers and the tokenizer's Unicode tables do not, for a set."""
    new = regex.findall(r"[\p{L}\p{N}]", "".join(c for c in map(chr, range(ord(LATER), 0x110000)) if unicodedata.category(c) == "Cn"))
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(f"&{c}" for c in new))
    return "".join(rf"\U{ord(new[at // 3]):08x}" for _, (at, end) in pieces if end - at == 2)


def _unicode(path: str) -> tuple:
    """How the tokenizer writes characters that other Unicode tables may not have (composed, and in lower case), and its _later_characters()."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer.normalizer.normalize_str, _later_characters(tokenizer)


class Automaton:
    """Compiled from a tokenizer file with byte-level symbols and a mark at the end of words."""

    def __init__(self, path: str):
        self.written, self.later = _unicode(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.word_pattern, self.end = split["pattern"]["Regex"], model["end_of_word_suffix"]
        vocab, names = model["vocab"], _byte_symbols()
        self.label = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # by label, in lists: a worker has one automaton, and an executor some workers
        most = max(self.label) + 1
        self.rank, self.left, self.right, self.merged = [-1] * most, [None] * most, [None] * most, {}
        spelt = {vocab[c]: bytes([b]) for b, c in enumerate(names)} | {vocab[c + self.end]: bytes([b]) + END for b, c in enumerate(names)}
        for k, pair in enumerate(model["merges"]):
            u, v = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            w = vocab[self.label[u] + self.label[v]]
            if u << 32 | v in self.merged or self.rank[w] >= 0:
                raise ValueError(f"merge {k} makes a label again")
            self.merged[u << 32 | v] = self.rank[w] = k
            self.left[w], self.right[w] = u, v
            spelt[w] = spelt[u] + spelt[v]
        #: Labels by their bytes, with END behind those that end a word.
        self.by = {x: w for w, x in spelt.items()}
        if len(self.by) < len(spelt):
            raise ValueError("two labels are spelt alike")
        #: Bytes of a label, and the longest other label that it begins with.
        self.size, self.shorter = [0] * most, [None] * most
        for w, x in spelt.items():
            self.size[w] = n = len(x.removesuffix(END) or x)
            self.shorter[w] = next((self.by[x[:k]] for k in range(n - 1, 0, -1) if x[:k] in self.by), None)
        self.longest = max(self.size)
        self.arcs: dict[int, bool] = {}
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.alone: dict[int, tuple[int]] = {}
        self.find = regex.compile(self.word_pattern).findall
        self.letters = self.find("ab") == ["ab"]
        later = self.later
        self.find_any = regex.compile("(?V1)" + self.word_pattern.replace(r"\p{L}", rf"[\p{{L}}--[{later}]]").replace(r"\p{N}", rf"[\p{{N}}--[{later}]]")).findall if later else self.find
        self.outside = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else lambda text: [text]

    def arc(self, s: int, t: int) -> bool:
        """Whether the automaton still has an arc t from the state s."""
        until, rank, merged, a, b, free = len(self.merged), self.rank, self.merged.get, s, t, True
        first = False  # whether only t's end unfolded at `until`: equal merges go from the left, so one across the gap comes first
        while True:
            ra, rb = rank[a], rank[b]
            since, k = max(ra, rb), merged(a << 32 | b, -1)
            if since < k < until or first and k == until:
                free = False
                break
            if since < 0:
                break
            until, first = since, ra < since
            if ra == since:
                a = self.right[a]
            if rb == since:
                b = self.left[b]
        if len(self.arcs) >= ARCS:
            self.arcs.clear()
        self.arcs[s << 32 | t] = free
        return free

    def path(self, word: bytes) -> list[int]:
        """The labels of the path that spells a word, with the mark at its end."""
        spelt, n, by, known, arc, size, shorter = word + END, len(word), self.by.get, self.arcs.get, self.arc, self.size, self.shorter
        out, dead, i, t, last, longest = [], None, 0, None, -1, self.longest
        while True:
            if t is None and (n - i > longest or (t := by(spelt[i:])) is None):  # the longest label from here on
                for end in range(min(n - 1, i + longest), i, -1):
                    if (t := by(spelt[i:end])) is not None:
                        break
            while t is not None:
                if last < 0 or (free := known(last << 32 | t)) or free is None and arc(last, t):
                    if not dead or i + size[t] not in dead:
                        break
                t = shorter[t]
            if t is not None:
                out.append(t)
                i += size[t]
                if i == n:
                    return out
                last, t = t, None
                continue
            while t is None:  # the one path that leads here leads no further
                dead = dead or set()
                dead.add(i)
                t = out.pop()
                last = out[-1] if out else -1
                i -= size[t]
                t = shorter[t]

    def shared(self, ids: list[int]) -> tuple[int, ...]:
        """ids as a tuple; of one id, always the same one, as most words have no more."""
        return tuple(ids) if len(ids) != 1 else self.alone.setdefault(ids[0], tuple(ids))

    def words(self, text: str) -> list[bytes]:
        """The pre-split words of a text without special tokens, as bytes."""
        if text.isascii():
            text = text.lower()
            return [text.encode()] if self.letters and text.isalpha() else [w.encode() for w in self.find(text)]
        if max(text) >= LATER:
            return [w.encode() for w in self.find_any(self.written(text.encode("utf-8", "replace").decode()))]
        text = unicodedata.normalize("NFC", text)
        # the library lowers each character by itself: no final sigma
        text = text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))
        return [w.encode() for w in (self.find if max(text) < LATER else self.find_any)(text)]

    def encode(self, text: str | None) -> list[int]:
        ids = []
        if not text:
            return ids
        for part in self.outside(text) if "<" in text else (text,):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for w in self.words(part):
                    if (found := self.known.get(w)) is None:
                        found = self.shared(self.path(w))
                        if len(self.known) >= WORDS:
                            self.known.clear()
                        if len(w) <= LONG:
                            self.known[w] = found
                    ids += found
        return ids

    def decode(self, ids) -> str:
        return " ".join([self.label[i] for i in ids if i in self.label])


@cache
def automaton(path: str) -> Automaton:
    """One for each worker process; what it took to make is given back."""
    try:
        return Automaton(path)
    finally:
        give_back()


@cache
def _kept(path: str, beside: bool) -> Kept:
    """Chunks' ids; fewer are kept beside other stages' workers."""
    own = automaton(path)
    parts = own.encode("Ab,") == own.encode("ab") + own.encode(",") == [*own.encode("AB"), *own.encode(",")]
    return Kept(lambda new: [own.shared(own.encode(c)) for c in new], KEPT_BESIDE if beside else KEPT_ALONE, add if parts else None)


def _joined(found: list[tuple[int, ...]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(found), np.int32)


def encode(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of docs: the ids of the whole text; null texts are empty."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept = _kept(vocabulary(name), True)
        try:
            for texts in slices(batches):
                yield pd.Series([_joined(found) for found in kept.of(texts)], dtype=object)
        finally:
            kept.forget()

    return docs.select("doc_id", ids("text").alias("ids"))


def decode(encoded: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of every row of (doc_id, ids): the arcs' labels with spaces between; null ids are empty, unknown ids are left out."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = automaton(vocabulary(name))
        for lists in batches:
            yield pd.Series([own.decode([] if x is None else x) for x in lists])

    return encoded.select("doc_id", text("ids").alias("text"))


def _digests(docs: DataFrame, name: str, with_ids: bool) -> DataFrame:
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, kept = automaton(vocabulary(name)), _kept(vocabulary(name), with_ids)
        decimal = {i: str(i) for i in own.label}
        try:
            for texts in slices(batches):
                rows = []
                for found in kept.of(texts):
                    ids = list(chain.from_iterable(found))
                    digest = [hashlib.sha256(" ".join(map(x.__getitem__, ids)).encode()).hexdigest() for x in (decimal, own.label)]
                    rows.append((len(ids), *digest, *((np.array(ids, np.int32),) if with_ids else ())))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
        finally:
            if with_ids:  # other stages' workers need the memory
                kept.forget()
                own.known.clear()
                give_back()

    return docs.select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")


def round_trip(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256 of the decimal ids and decoded_sha256 of what they decode to.

    Null and empty texts have no ids. Columns other than doc_id and text are left out; repeated rows stay.
    """
    return _digests(docs, name, False)


def encode_and_check(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """As round_trip(), and the ids."""
    return _digests(docs, name, True)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
