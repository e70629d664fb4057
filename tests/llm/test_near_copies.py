import random

import corpus_pipeline as cp
import pytest
from pyrelake.llm import near_copies
from pyrelake.llm.near_copies import near_links
from pyrelake.llm.op5_simhash import fingerprint

DOCS = "doc_id long, text string"


def grams(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """The smallest id of the group of each row, by all pairs."""
    sets, name = [(i, grams(t)) for i, t in rows], {i: i for i, _ in rows}
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 5 * len(a & b) >= 4 * len(a | b)]
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            if name[i] != name[j]:
                name[i] = name[j] = min(name[i], name[j])
                changed = True
    return name


def groups(links, rows):
    name, changed = {i: i for i, _ in rows}, True
    while changed:
        changed = False
        for u, v in links:
            if name[u] != name[v]:
                name[u] = name[v] = min(name[u], name[v])
                changed = True
    return name


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return out


def found(spark, rows):
    return groups([(r.u, r.v) for r in near_links(spark.createDataFrame(rows, DOCS)).collect()], rows)


def test_near_copies_match_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 8, 40, 150, 400]))]
        for _ in range(5):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 1, 2, len(base) // 60, len(base) // 45])))))
    rows += [(len(rows), ""), (len(rows) + 1, " \n"), (len(rows) + 2, "ONE two"), (len(rows) + 3, "one  Two")]
    assert found(spark, rows) == brute(rows)


def test_large_posting_lists_lose_no_link(spark):
    """Near copies of one text, and texts that share a passage: of these some are near copies of each other and not of the smallest."""
    rng = random.Random(6)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for i in range(150):
        rows.append((len(rows), " ".join(edited(rng, shared, rng.randrange(3)))))
        tail = [f"t{i // 3}_{k}" for k in range(rng.choice([10, 40]))]
        rows.append((len(rows), " ".join(shared + edited(rng, tail, 1))))
    rng.shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want and 20 < len(set(want.values())) < 290


@pytest.mark.parametrize(("pivoted", "small"), [(8, 64), (2, 3), (10**6, 2)])
def test_chains_of_copies_whatever_is_connected_early(spark, monkeypatch, pivoted, small):
    """Texts of a row that each differ a little from the one before: only neighbours are near."""
    monkeypatch.setattr(near_copies, "PIVOTED", pivoted)
    monkeypatch.setattr(near_copies, "SMALL_BUCKET", small)
    rng = random.Random(8)
    rows = []
    for c in range(3):
        words = [f"c{c}w{i}" for i in range(100)]
        for _ in range(30):
            rows.append((len(rows), " ".join(words)))
            words = edited(rng, words, 2)
    rng.shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want and len(set(want.values())) < 40


def test_shingles_that_many_texts_share_are_put_last(spark, monkeypatch):
    """A line in many texts, which no sample shows; some of the texts are copies of each other besides."""
    monkeypatch.setattr(near_copies, "COMMON", 1)
    rng = random.Random(10)
    line, rows = [f"s{i}" for i in range(14)], []
    for k in range(120):
        own = [f"t{k}_{i}" for i in range(rng.choice([12, 20, 60]))]
        rows += [(len(rows) + j, " ".join(edited(rng, own, j % 2) + line)) for j in range(rng.choice([1, 1, 2]))]
    tried = []
    again = near_copies._prefixed_again
    monkeypatch.setattr(near_copies, "_prefixed_again", lambda *a: tried.append(len(a[-1])) or again(*a))
    want = brute(rows)
    assert found(spark, rows) == want and len(set(want.values())) < len(rows) and tried and tried[0] > 0


def test_very_long_near_copies(spark):
    """Copies of 20,000 words, each edited in places of its own; few pairs are listed."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    rows = [(k, " ".join(edited(rng, base, 150))) for k in range(40)] + [(100, "something else of a few words only")]
    links = [(r.u, r.v) for r in near_links(spark.createDataFrame(rows, DOCS)).collect()]
    assert set(groups(links, rows).values()) == {0, 100} and len(links) < 300


def test_the_stage_drops_copies_beyond_two_bits(spark, sf):
    rng = random.Random(7)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    copies = [" ".join(edited(rng, base, 3)) for _ in range(40)]
    bits = [(fingerprint(" ".join(base)) ^ fingerprint(c)) % 2**64 for c in copies]
    copy = next(c for c, b in zip(copies, bits, strict=True) if b.bit_count() > 2)
    rows = [(1, " ".join(base)), (2, copy), (3, "another text of some words altogether"), (None, copy)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS + ", lang string, source string, n_chars long")
    assert sorted(str(r.doc_id) for r in cp.distinct_documents(spark, docs, sf).collect()) == ["1", "3", "None"]


def test_of_shingles_that_are_put_last_the_rarest_come_first(spark):
    text = " ".join(f"w{i}" for i in range(30))
    last = near_copies.shingles(text)[::-1].copy()  # 26, the first of them the rarest
    df = spark.createDataFrame([(1, text)], DOCS)
    assert df.select(near_copies._prefixes(last)("text").alias("s")).first().s.prefix == last[:6].tolist()


def test_groups_that_share_their_lists_are_connected_in_one_round(spark, monkeypatch):
    """Copies of two texts in the same lists: one pivot a list would connect the one group or the other."""
    monkeypatch.setattr(near_copies, "ROUNDS", 1)
    docs = [(k, " ".join([f"g{k // 6}w{i}" for i in range(60)] + [f"own{k}"])) for k in range(12)]
    live = [(g, k, 57, g, 12) for g in range(12) for k in range(12)]
    links, named = near_copies._pivots(spark.createDataFrame(live, "g long, node long, n int, pos int, size long"), spark.createDataFrame(docs, DOCS))
    assert sorted((r.node, r.component) for r in named.collect()) == [(k, k // 6 * 6) for k in range(12)]


def test_no_rows_are_given_from_python(spark, monkeypatch):
    """Such rows start a second kind of Python worker, whose idle processes stand beside the next stages' in an executor's memory."""
    rng, given = random.Random(3), []
    monkeypatch.setattr(near_copies, "SMALL_BUCKET", 4)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(edited(rng, base, i % 3))) for i in range(30)]
    shared = [f"c{k}" for k in range(30)]
    rows += [(i, " ".join([*shared, *(f"x{rng.randrange(10**6)}" for _ in range(60))])) for i in range(30, 50)]
    docs = spark.createDataFrame(rows, DOCS)
    late, real = [], near_copies._late
    monkeypatch.setattr(near_copies, "_late", lambda live: late.append(real(live)) or late[-1])
    monkeypatch.setattr(near_copies, "_common", lambda docs: near_copies.np.zeros(0, near_copies.np.int64))
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda self, *a, f=type(spark.sparkContext).parallelize: given.append(a) or f(self, *a))
    links = [(r.u, r.v) for r in near_links(docs).collect()]
    assert len(late[0]) and groups(links, rows) == brute(rows) and not given
