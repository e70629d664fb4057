import random

from pyrelake.llm.op7_decontamination import Matcher, best_match, budget, contaminated, op7_decontamination, pieces, plain


def least(item, text):
    """Sellers' dynamic programme, column by column."""
    col, best = list(range(len(item) + 1)), len(item)
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(col[i] + (x != c), col[i + 1] + 1, new[i] + 1))
        col = new
        best = min(best, col[-1])
    return best


def edited(rng, text, n):
    t = list(text)
    for _ in range(n):
        k = rng.randrange(len(t))
        t[k : k + 1] = [[], [rng.choice("xyz ")], [t[k], "q"]][rng.randrange(3)]
    return "".join(t)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        assert best_match(item, text)[0] == least(item, text)


def test_pieces_cover_the_item():
    item = plain("The quick brown fox jumps over the lazy dog, and then over another one.")
    cut = pieces(item)
    assert "".join(p for _, p in cut) == item and len(cut) == budget(item) + 1
    assert all(item[o : o + len(p)] == p for o, p in cut)


def test_whole_table_matches_brute_force(spark, sf):
    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text[:1500]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(30).collect()]
    for k in range(30):
        i, t = items[rng.randrange(len(items))]
        docs.append((10_000 + k, f"Some words before. {edited(rng, t, rng.choice([0, 1, 5, 12, 16, 25])).upper()} And after."))
    want = {(d, i) for d, t in docs for i, x in items if least(plain(x), plain(t)) <= budget(plain(x))}
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) and len(want) > 10
    by_id, texts = dict(items), dict(docs)
    for r in got:
        assert r.distance == least(plain(by_id[r.item_id]), plain(texts[r.doc_id]))
    exact = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, x in items if plain(x) in plain(r.text)}
    assert {(r.doc_id, r.item_id) for r in op7_decontamination(spark, sf).where("distance = 0").collect()} == exact


def test_blocks_of_the_benchmark_find_the_same(spark, sf, monkeypatch):
    from pyrelake.llm import op7_decontamination as op7

    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want, kept = key(contaminated(docs, items)), key(op7.without_leaks(docs, items).select("doc_id"))
    monkeypatch.setattr(op7, "BLOCK_CHARS", 1 + sum(len(r.text) for r in items.collect()) // 3)
    assert key(contaminated(docs, items)) == want and len(want) > 0
    assert key(op7.without_leaks(docs.withColumn("leaks", docs.n_chars), items).select("doc_id")) == kept
    assert {k for k, in kept} == {r.doc_id for r in docs.collect()} - {r[0] for r in want}


def test_whole_texts_with_edits(spark, sf):
    """Edited items in the middle of whole long documents."""
    rng = random.Random(11)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(4).collect()]
    texts = sorted((r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), key=len)[-3:]
    docs = []
    for k, t in enumerate(texts):
        half = len(t) // 2
        docs.append((k, f"{t[:half]} {edited(rng, items[k][1], 4)} {t[half:][:20_000]}"))
    found = {(r.doc_id, r.item_id): r.distance for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for d, t in docs:
        for i, x in items:
            n = least(plain(x), plain(t)) if d == 0 else None
            if n is not None:
                assert found.get((d, i)) == (n if n <= budget(plain(x)) else None)
        assert (d, items[d][0]) in found


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, None, 0), (2, "", 1), (3, "the same line of some words here and", 1), (3, "the same line of some words here the same", 1), (None, "x" * 50, 1), (4, "long text with many words and a 42 in it", 1)], "item_id long, text string, doc_id int")
    assert sorted({(r.doc_id, r.item_id) for r in contaminated(odd_docs, items).collect()}) == [(6, 3), (7, 4)]
    assert contaminated(odd_docs.limit(0), items).collect() == [] and contaminated(odd_docs, items.limit(0)).collect() == []
    assert Matcher([]).find("text") == []
