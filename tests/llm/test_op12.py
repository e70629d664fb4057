import re
import zlib
from collections import Counter

import pytest
from pyrelake.llm import op12_spelling as op12
from pyspark.sql import functions as F

LETTERS = op12._LOWER + "".join(map(chr, range(0xC0, 0x100)))


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def neighbours(w):
    cuts = [(w[:k], w[k:]) for k in range(len(w) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in LETTERS} | {a + c + b for a, b in cuts for c in LETTERS}


def brute(docs):
    n, out = brute_words(docs), {}
    for w in n:
        near = [v for v in neighbours(w) if v in n and v != w]
        top = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = [w, top if top and n[top] >= 2 * n[w] else None, None, n[w], len(near), None]
    for w, row in out.items():
        at = w
        while out[at][1]:
            at = out[at][1]
        row[2] = at
        row[5] = n[row[1]] if row[1] else None
    return sorted(map(tuple, out.values()))


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("large", [1024, 3, 1])
def test_matches_brute_force(spark, sf, monkeypatch, large):
    monkeypatch.setattr(op12, "LARGE", large)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    if large < 1024:
        docs = docs[:60]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(op12.spelling_variants(df) if large < 1024 else op12.op12_spelling(spark, sf)) == brute(docs)


def test_chains_ties_and_letters(spark):
    texts = [("spelling", 40), ("speling", 18), ("spelin", 8), ("spekin", 3), ("spelung", 18), ("aaaaa", 9), ("aaaaaa", 3), ("aaaaab", 5), ("baaaaa", 5), ("STRAßE", 9), ("strasße", 3), ("Éclair", 7), ("éclair", 3), ("abcd", 50), ("abcde", 2)]
    docs = [(k, " 1 ".join([w] * n)) for k, (w, n) in enumerate(texts)]
    assert found(op12.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_masks_part_by_two_bits_at_most(spark):
    rows = [(w, v) for w in ("spelling", "straße", "àéîõü", "aabbc") for v in sorted(neighbours(w))]
    df = spark.createDataFrame(rows, "w string, v string")
    assert df.agg(F.max(F.bit_count(op12.mask(F.col("w")).bitwiseXOR(op12.mask(F.col("v"))))).alias("most")).first().most == 2
    assert set(op12.bits()) == set(LETTERS) and max(op12.bits().values()) < 63


def test_odd_documents(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(op12.spelling_variants(odd_docs.withColumn("word", F.lit(1)).withColumn("bits", F.lit("x")))) == brute(docs)
    assert found(op12.spelling_variants(odd_docs.limit(0))) == []
