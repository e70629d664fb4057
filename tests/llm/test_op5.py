import random
import re

import xxhash
from pyrelake.llm.op5_simhash import fingerprint, op5_simhash, simhash_groups


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = {}
    for i, t in rows:
        fps.setdefault(plain(t), []).append(i)
    names, keys = {f: min(v) for f, v in fps.items()}, list(fps)
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (a ^ b).bit_count() <= 2 and names[b] < names[a]:
                    names[a], changed = names[b], True
    return sorted((i, f"{f:016x}", names[f]) for f, v in fps.items() for i in v)


def test_fingerprint_is_that_of_the_plain_rule():
    for t in (None, "", "  \t\n", "A", "A b", "A B c d É É é", "x y z\x85 w  q\x0bp", "a a a a b"):
        assert fingerprint(t) % 2**64 == plain(t)


def test_groups_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op5_simhash(spark, sf).collect())) == brute(rows)


def test_large_posting_lists_lose_no_link(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(60)] = f"z{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    got = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_odd_rows(spark, odd_docs):
    got = [tuple(r) for r in simhash_groups(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    zero = {r[0]: r[2] for r in got if r[1] == "0" * 16}
    assert zero == {1: 1, 2: 1, 3: 1}
    assert simhash_groups(odd_docs.limit(0)).collect() == []
