"""Texts as chunks between white space, with what each distinct chunk gives kept within a bound.

The tokenizers at hand drop or mark white space and never join across it, so a text's tokens are those of
its chunks in turn. Words follow a steep distribution: a few hundred thousand kept chunks answer most
look-ups, and what is not kept is worked out again, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: str.split() also splits at these four, which are no white space to a tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Chunks in each of the two generations that a worker keeps.
KEPT = 180_000
#: Longer chunks are never kept.
LONG = 64
#: Marks that may stand behind a word, and the end of the scripts whose letters were assigned long ago.
MARKS, LATIN = ",.;:!?*$%&#|", "\u0250"
#: Chunks looked up together.
TOGETHER = 50_000


def chunks(text: str | None, fold: bool = False) -> list[str]:
    """A text's chunks; with fold, A-Z in lower case, for tokenizers that do so themselves.

    Special tokens are told from ordinary text by their case, so texts that may hold any are not folded.
    """
    if not text:
        return []
    if fold and "<|" not in text:
        text = text.lower() if text.isascii() else text.encode("utf-8", "replace").lower().decode()
    if any(c in text for c in _SEPARATORS):
        return [c for c in _SPACES.split(text) if c]
    return text.split()


class Kept:
    """make(list of distinct chunks) gives a value for each; of(texts) yields each text's values in order.

    When the younger generation is full it becomes the elder one, and the elder is dropped; what is used
    again moves to the younger. So frequent chunks stay, and rare ones go after a while.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int = KEPT, join: Callable | None = None):
        """join(a, b): the value of two chunks written together, for tokenizers that lower case and part words from marks.

        With it, a word with marks behind it is looked up as the two.
        """
        self.make, self.most, self.join, self.young, self.old = make, most, join, {}, {}

    def forget(self) -> None:
        """For the end of a task: an idle worker holds on to nothing."""
        self.young, self.old = {}, {}

    def of(self, texts):
        """Some texts at a time, so that what is new in several is made once and together."""
        some, size = [], 0
        for text in texts:
            some.append(chunks(text, self.join is not None))
            size += len(some[-1])
            if size >= TOGETHER:
                yield from self._found(some)
                some, size = [], 0
        yield from self._found(some)

    def values(self, distinct: list[str]) -> list:
        """The value of each of some distinct chunks."""
        young = self.young
        found = list(map(young.get, distinct))
        places = [k for k, v in enumerate(found) if v is None]
        if places:
            missing = [distinct[k] for k in places]
            made = self._ready(set(missing))
            for k, c in zip(places, missing, strict=True):
                found[k] = young[c]
            self._age(made)
        return found

    def _found(self, some: list[list[str]]):
        young = self.young
        missing = self._ready(set().union(*some).difference(young))
        for parts in some:
            yield list(map(young.__getitem__, parts))
        self._age(missing)

    def _ready(self, missing: set[str]) -> set[str]:
        """Puts them into the younger generation, where they are not; gives them and the parts they were made of."""
        young, old = self.young, self.old
        if missing:
            new = []
            for c, v in zip(missing, map(old.get, missing), strict=True):
                if v is None:
                    new.append(c)
                else:
                    young[c] = v
            marked = {}
            if self.join:
                for c in new:
                    if c[-1:] in MARKS and (word := c.rstrip(MARKS)) and word.lower().isalpha() and max(word) < LATIN:  # a dotted capital I ends in a mark
                        marked[c] = word, c[len(word) :]
            if marked:
                whole = set(new).difference(marked)
                whole.update(w for parts in marked.values() for w in parts if w not in young)
                back = [w for w in whole if w in old]
                young.update((w, old[w]) for w in back)
                new = list(whole.difference(back))
                missing |= whole
            young.update(zip(new, self.make(new), strict=True))
            for c, (word, rest) in marked.items():
                young[c] = self.join(young[word], young[rest])
        return missing

    def _age(self, missing: set[str]) -> None:
        for c in [c for c in missing if len(c) > LONG]:
            del self.young[c]
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
