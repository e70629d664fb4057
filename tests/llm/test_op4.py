import hashlib
import random
import subprocess
import sys
import unicodedata
from pathlib import Path

import pytest
import regex
from pyrelake.llm.op4_bpe import automaton, decode, encode, round_trip, vocabulary
from tokenizers import Tokenizer

ODD = ["", " ", "Hello, it's a dog's 42!! naïve É́ 中文　x", "a<|endoftext|>b<|startoftext|> <|ENDOFTEXT|> x", "tab\tnew\nline\x1cy\x85z\xa0q", "İstanbul ǅ ß ΣΑΣ Σ", "á b ́c", "\x00\x01ab", "don't DON'T 's'", "aaaaaaaaaaaaaaaaaaaaaaa inininininin", "\U0001f600\U0001f468‍\U0001f469", "x" * 5000, "ethanol" * 20000, "!?!?....---___"]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(vocabulary())


def test_paths_are_what_the_library_gives(lib):
    own, rng = automaton(vocabulary()), random.Random(5)
    letters = "ethainsor"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 24))) for _ in range(20000)]
    words += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x600), rng.randrange(0x4E00, 0x9000)])) for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    words += [t.replace("</w>", "") for t in list(own.label.values())[:20000]]
    for text in ODD + words:
        e = lib.encode(text, add_special_tokens=False)
        assert own.encode(text) == e.ids, text
        assert own.decode(e.ids) == lib.decode(e.ids, skip_special_tokens=False)


def test_every_code_point(lib):
    own = automaton(vocabulary())
    known = regex.compile(r"[^\p{Cn}\p{Co}\p{Cs}]").match  # assigned in tables later than this Python's
    points = [f"a{chr(c)}b {chr(c)}" for c in range(0x110000) if known(chr(c)) or c % 97 == 0 and not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 500):
        text = " . ".join(points[k : k + 500])
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids, hex(ord(points[k][1]))


def test_marks_in_any_order(lib):
    own, rng = automaton(vocabulary()), random.Random(8)
    marks = [chr(c) for c in range(0x300, 0x11000) if unicodedata.combining(chr(c))] + [chr(c) for c in (0x897, 0x10D69, 0x113CE, 0x1612F, 0x16D67)]
    for _ in range(5000):
        text = "".join(rng.choice(["a", "e", "O", "\u105d2", "\u0b47", *rng.sample(marks, 3)]) for _ in range(6))
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids, ascii(text)


def digest(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_whole_table(spark, sf, lib):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in round_trip(docs).collect():
        assert tuple(r)[1:] == digest(lib, texts[r.doc_id])


def test_odd_rows(spark, odd_docs, lib):
    rows = round_trip(odd_docs).collect()
    assert sorted(tuple(r)[1:] for r in rows) == sorted(digest(lib, r.text) for r in odd_docs.collect())
    assert round_trip(odd_docs.limit(0)).collect() == []
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    coded = encode(odd)
    for r in coded.collect():
        assert r.ids == lib.encode(ODD[r.doc_id], add_special_tokens=False).ids
    for r in decode(coded).collect():
        assert r.text == lib.decode(lib.encode(ODD[r.doc_id], add_special_tokens=False).ids, skip_special_tokens=False)


def test_an_automaton_takes_little_memory():
    """Each worker of an executor has one: 120 MB before they were lists and flat tables, some 50 now."""
    code = """
import re, pyspark.worker, pandas, pyarrow
from pyrelake.llm.op4_bpe import automaton, vocabulary
now = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
before, own = now(), automaton(vocabulary())
print(now() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 75
