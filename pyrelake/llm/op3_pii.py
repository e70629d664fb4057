"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel network.

Values are found by pattern and checked by what makes them valid (a checksum, an octet's range, a calendar),
then permuted within their format: a card number becomes another card number, a date another date. The
permutation depends on the key and the format alone, so equal values stay equal in all documents, and
different ones different; whoever holds the key can undo it. What is not valid stays as it is.

A format is a number of values, N. A value's rank is split into two parts that a Feistel network mixes by
turns, adding keyed digests modulo the parts' sizes; ranks past N are walked on. A network E alone may leave
a value as it is; E(E^-1(x) + 1) never does.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: For tests, and for the registered query where the session does not name a key in KEY_SETTING; give a secret of your own.
KEY = b"replace this key"
KEY_SETTING = "spark.pyrelake.pii.key"
ROUNDS = 8
#: Years whose days are the format of a date.
YEARS = (1900, 2099)


class Feistel:
    """A keyed permutation of range(n) for each format, a name and n."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, name: str, n: int, rank: int, back: bool) -> int:
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        width = (max(a, b).bit_length() + 71) // 8
        while True:
            x, y = divmod(rank, b)
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                own, other, size = (x, y, a) if r % 2 == 0 else (y, x, b)
                head = f"{name}/{n}/{r}/{other}/".encode()
                digest = b"".join(hashlib.blake2b(head + bytes([k]), key=self.key, digest_size=64).digest() for k in range(-(-width // 64)))
                step = int.from_bytes(digest[:width], "big")
                own = (own - step if back else own + step) % size
                x, y = (own, other) if r % 2 == 0 else (other, own)
            rank = x * b + y
            if rank < n:
                return rank

    def forward(self, name: str, n: int, rank: int) -> int:
        return rank if n < 2 else self._mix(name, n, (self._mix(name, n, rank, True) + 1) % n, False)

    def back(self, name: str, n: int, rank: int) -> int:
        return rank if n < 2 else self._mix(name, n, (self._mix(name, n, rank, True) - 1) % n, False)


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Permute = Callable[[str, int, int], int]


def spelt(permute: Permute, name: str, text: str) -> str:
    """Permutes the letters and digits of a text, each within its kind; other characters stay."""
    kinds = [next((k for k in (_DIGITS, _LOWER, _UPPER) if c in k), "") for c in text]
    n, rank = 1, 0
    for c, k in zip(text, kinds, strict=True):
        if k:
            n, rank = n * len(k), rank * len(k) + k.index(c)
    shape = hashlib.blake2b("|".join(f"{len(k)}" if k else c for c, k in zip(text, kinds, strict=True)).encode(), digest_size=8).hexdigest()
    rank, out = permute(f"{name}:{shape}", n, rank), []
    for c, k in reversed(list(zip(text, kinds, strict=True))):
        if k:
            rank, digit = divmod(rank, len(k))
            c = k[digit]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The digit that makes the digits before it valid."""
    return -sum(v if i % 2 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(digits)))) % 10


def _filled(pattern: str, digits: str) -> str:
    """pattern with its digits replaced in turn."""
    left = iter(digits)
    return "".join(next(left) if c in _DIGITS else c for c in pattern)


def card(permute: Permute, text: str) -> str | None:
    """13 to 19 digits with a valid check digit; the first digit stays."""
    digits = "".join(c for c in text if c in _DIGITS)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]):
        return None
    body = digits[1:-1]
    new = digits[0] + f"{permute('card', 10 ** len(body), int(body)):0{len(body)}d}"
    return _filled(text, new + str(luhn(new)))


def ip(permute: Permute, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
        return None
    rank = permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
    return ".".join(map(str, rank.to_bytes(4, "big")))


_NETS = [ipaddress.ip_network(n) for n in ("2000::/3", "fc00::/7", "fe80::/10")]


def ipv6(permute: Permute, text: str) -> str | None:
    """Global, local and link-local addresses, each within its network; written in the short form."""
    try:
        old = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    for net in _NETS:
        if old in net:
            return str(net[permute(f"ipv6 {net}", net.num_addresses, int(old) - int(net[0]))])
    return None


def phone(permute: Permute, text: str) -> str | None:
    """A country's prefix stays. In the North American plan, area and exchange begin with 2 to 9; other numbers need a prefix."""
    prefix = re.match(r"\+\d{1,3}(?=\D)|", text)[0]
    rest = text[len(prefix) :]
    digits = "".join(c for c in rest if c in _DIGITS)
    planned = len(digits) == 10 and digits[0] not in "01" and digits[3] not in "01"
    if prefix in ("", "+1") and planned:
        rank = ((int(digits[:3]) - 200) * 800 + int(digits[3:6]) - 200) * 10000 + int(digits[6:])
        rank, line = divmod(permute("phone", 800 * 800 * 10000, rank), 10000)
        new = f"{rank // 800 + 200}{rank % 800 + 200}{line:04d}"
    elif not prefix or not 6 <= len(digits) <= 12:
        return None
    else:
        new = digits
        while True:  # walks on to the next number outside the plan
            new = f"{permute('phone' + prefix, 10 ** len(digits), int(new)):0{len(digits)}d}"
            if prefix != "+1" or len(digits) != 10 or new[0] in "01" or new[3] in "01":
                break
    return prefix + _filled(rest, new)


def ssn(permute: Permute, text: str) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    rank = permute("ssn", 898 * 99 * 9999, ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1)
    rank, serial = divmod(rank, 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def iban(permute: Permute, text: str) -> str | None:
    plain = text.replace(" ", "")
    check = lambda country, body: 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    if not 15 <= len(plain) <= 34 or check(plain[:2], plain[4:]) != int(plain[2:4]):
        return None
    body = spelt(permute, "iban" + plain[:2], plain[4:])
    left = iter(f"{plain[:2]}{check(plain[:2], body):02d}{body}")
    return "".join(c if c == " " else next(left) for c in text)


_FIRST = datetime.date(YEARS[0], 1, 1).toordinal()
_DAYS = datetime.date(YEARS[1], 12, 31).toordinal() - _FIRST + 1


def date(permute: Permute, text: str) -> str | None:
    """Year first or last, with - / or . between; of the two orders with the year last, day first where both are possible.

    What is read month first must be read so again: it walks on to a day after the twelfth. Such a date may so part from
    its other spellings.
    """
    a, mark, b, c = re.fullmatch(r"(\d+)([-/.])(\d+)[-/.](\d+)", text).groups()
    orders = [(0, 1, 2)] if len(a) == 4 else [(2, 1, 0), (2, 0, 1)]
    for order in orders:
        y, m, d = ((a, b, c)[k] for k in order)
        try:
            day = datetime.date(int(y), int(m), int(d))
        except ValueError:
            continue
        if not YEARS[0] <= day.year <= YEARS[1]:
            continue
        new = day
        while new == day or order == (2, 0, 1) and new.day <= 12:
            new = datetime.date.fromordinal(_FIRST + permute("date", _DAYS, new.toordinal() - _FIRST))
        parts = {order[0]: f"{new.year}", order[1]: f"{new.month:02d}", order[2]: f"{new.day:02d}"}
        return mark.join(parts[k] for k in range(3))
    return None


_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_NAMED = re.compile(r"(?P<d>\d{1,2})(?P<th>st|nd|rd|th|)(?P<s1> (?:of )?)(?P<m>[A-Za-z]+)(?P<s2>\.?,? )(?P<y>\d{4})|(?P<M>[A-Za-z]+)(?P<S1>\.? )(?P<D>\d{1,2})(?P<TH>st|nd|rd|th|)(?P<S2>,? )(?P<Y>\d{4})")


def named_date(permute: Permute, text: str) -> str | None:
    """A date with its month's name, English, in full or by three letters; the same permutation as of other dates.

    May is taken to be in full: dates of three-letter months walk on past it.
    """
    m = _NAMED.fullmatch(text)
    first = m["D"] is not None
    day, th, month, year = (m[k.upper() if first else k] for k in ("d", "th", "m", "y"))
    at = next((k for k, name in enumerate(_MONTHS, 1) if month.title() in (name, name[:3])), 0)
    short = at > 0 and month.title() != _MONTHS[at - 1]
    try:
        new = datetime.date(int(year), at, int(day))
    except ValueError:
        return None
    if not YEARS[0] <= new.year <= YEARS[1]:
        return None
    while True:
        new = datetime.date.fromordinal(_FIRST + permute("date", _DAYS, new.toordinal() - _FIRST))
        if not short or new.month != 5:
            break
    name = _MONTHS[new.month - 1][: 3 if short else None]
    name = name.upper() if month.isupper() else name.lower() if month.islower() else name
    ends = {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th") if new.day // 10 != 1 else "th"
    days = f"{new.day:02d}" if day[0] == "0" else str(new.day)
    days += ends if th else ""
    return f"{name}{m['S1']}{days}{m['S2']}{new.year}" if first else f"{days}{m['s1']}{name}{m['s2']}{new.year}"


def email(permute: Permute, text: str) -> str:
    """The part before @ and the host's labels but the last."""
    local, _, host = text.partition("@")
    labels = host.split(".")
    return f"{spelt(permute, 'local', local)}@{'.'.join([*(spelt(permute, 'host', x) for x in labels[:-1]), labels[-1]])}"


def secret(permute: Permute, text: str) -> str:
    known = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|", text)[0]
    return known + spelt(permute, "secret", text[len(known) :])


_NAMES = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + ")"
_FOUND = re.compile(
    r"(?<![A-Za-z0-9])(?P<key>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])"
    r"|(?i:(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<secret>[A-Za-z0-9_+/.-]{7,}[A-Za-z0-9_+/-]|(?=(?<==)|(?<==[\"'])|[A-Za-z_+/.-]{0,6}\d)[A-Za-z0-9_+/.-]{0,6}[A-Za-z0-9_+/-])"
    r"|(?<![A-Za-z0-9._%+-])(?P<email>[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![A-Za-z0-9-])"
    r"|(?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
    r"|(?<![\w:.])(?P<ipv6>(?:[23][0-9A-Fa-f]{3}|[Ff][CDcd][0-9A-Fa-f]{2}|[Ff][Ee][89ABab][0-9A-Fa-f]):[0-9A-Fa-f:]{0,33}(?:[0-9A-Fa-f]|:))(?!\w|:\w|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w./-])(?P<date>\d{4}(?P<m1>[-/.])\d{1,2}(?P=m1)\d{1,2}|\d{1,2}(?P<m2>[-/.])\d{1,2}(?P=m2)\d{4})(?!(?!T\d\d:\d\d)[\w/-]|\.\d)"
    rf"|(?<![\w./-])(?i:(?P<named>\d{{1,2}}(?:st|nd|rd|th|) (?:of )?{_NAMES}\.?,? \d{{4}}|{_NAMES}\.? \d{{1,2}}(?:st|nd|rd|th|),? \d{{4}}))(?![\w/-]|\.\d)"
    r"|(?<![\w+])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}(?P<m3>[ .-])\d{3}(?P=m3)\d{4})(?!\w)"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?<![\w.])(?P<card>\d(?:[ -]?\d){12,40})(?!\w)"
)
_WORD = re.compile(r"[\w+]+")
_KINDS = {"key": secret, "secret": secret, "email": email, "ip": ip, "ipv6": ipv6, "ssn": ssn, "date": date, "named": named_date, "phone": phone, "iban": iban, "card": card}


def _cards(permute: Permute, text: str, at: int) -> Iterator[tuple[int, int, str]]:
    """The valid cards in a run of groups of digits: whole groups, the leftmost and longest first."""
    groups = [m.span() for m in re.finditer(r"\d+", text)]
    k = 0
    while k < len(groups):
        for last in range(len(groups), k, -1):
            a, b = groups[k][0], groups[last - 1][1]
            if b - a <= 40 and (new := card(permute, text[a:b])):
                yield at + a, at + b, new
                k = last - 1
                break
        k += 1


def _phones(permute: Permute, text: str, at: int) -> Iterator[tuple[int, int, str]]:
    """A phone number that took in groups of digits after it is tried again without them."""
    while True:
        if new := phone(permute, text):
            yield at, at + len(text), new
            return
        shorter = re.match(r"(.*\d)[ .-]\d+$", text)
        if not shorter:
            return
        text = shorter[1]


def found(text: str, permute: Permute) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of every valid value, in order."""
    out, at = [], 0
    while m := _FOUND.search(text, at):
        kind = next(k for k in _KINDS if m[k] is not None)
        start, end = m.span(kind)
        if kind == "card":
            hits = list(_cards(permute, m[kind], start))
        elif kind == "phone":
            hits = list(_phones(permute, m[kind], start))
        else:
            new = _KINDS[kind](permute, m[kind])
            hits = [(start, end, new)] if new else []
        out += [(kind, *h) for h in hits]
        # after a value that is not valid, what begins later in it is still looked at
        at = hits[-1][1] if hits and kind in ("card", "phone") else end if hits else next((x.end() for x in [_WORD.match(text, start)] if x), start + 1)
    return out


def replaced(text: str, permute: Permute) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what they replace in the old one."""
    hits, out, at = found(text, permute), [], 0
    for _, a, b, new in hits:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [h[:3] for h in hits]


def _may_hold(text: str | None) -> bool:
    return bool(text) and ("@" in text or "=" in text or ":" in text or any(d in text for d in _DIGITS))


def pseudonymized(docs: DataFrame, key: bytes = KEY, undo: bool = False) -> DataFrame:
    """Per row of docs: doc_id, text with pseudonyms, and spans: (kind, start, end) in the old text.

    Null texts stay null, without spans; repeated rows stay; other columns are left out. undo takes texts back, but for
    leading zeros of dates and the spelling of addresses. A bare ten-digit number has nothing to check and stays.
    """

    @F.pandas_udf("text string, spans array<struct<kind:string,start:int,end:int>>")
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        network = Feistel(key)
        permute = lru_cache(100_000)(network.back if undo else network.forward)
        for texts in slices(batches):
            rows = [replaced(t, permute) if _may_hold(t) else (t, []) for t in texts]
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for _, x in rows]
            yield pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object), "spans": pd.Series(spans, dtype=object)})

    return docs.select("doc_id", replace("text").alias("r")).select("doc_id", "r.*")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None)
    out = pseudonymized(table(spark, sf_dir, "documents"), key.encode() if key else KEY)
    return out.select("doc_id", "text", F.size("spans").cast("long").alias("n_found"), F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))).alias("spans"))
