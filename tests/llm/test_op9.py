import random

import pytest
from pyrelake.llm.op9_line_dedup import dedup_lines, duplicate_lines, line_report, within_one_edit
from pyspark.sql import functions as F


def close(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(rows, least=20):
    seen = [(i, n, " ".join(t.split()).lower()) for i, text in rows for n, t in enumerate(text.split("\n"))]
    seen = sorted(x for x in seen if x[2])
    texts = sorted({x[2] for x in seen})
    name = {t: k for k, t in enumerate(texts)}
    edges = [(a, b) for k, a in enumerate(texts) for b in texts[k + 1 :] if min(len(a), len(b)) >= least and close(a, b)]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if name[a] != name[b]:
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    kept, gone = set(), []
    for i, n, t in seen:
        if name[t] in kept:
            gone.append((i, n))
        kept.add(name[t])
    return sorted(gone)


def variants(rng, n):
    base = "the quick brown fox jumps over the lazy dög again"
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            k, how = rng.randrange(len(t)), rng.randrange(3)
            t[k : k + 1] = [[], [rng.choice("xyzé")], [t[k], "q"]][how]
        out.append("".join(t))
    return out


@pytest.mark.parametrize("n", [30, 400])
def test_classes_match_brute_force_with_small_and_large_entries(spark, n):
    rng = random.Random(n)
    lines = variants(rng, n) + [f"a line of its own number {i * 7919}" for i in range(40)]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(len(lines) // 4)]
    got = duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.line_no) for r in got.collect()) == brute(rows)


def test_long_lines_in_large_entries(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcde fghij é") for _ in range(700)).strip() + "end"
    lines = []
    for _ in range(150):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            k, how = rng.choice([0, 5, 127, 128, 129, 350, 351, 352, 512, 600, len(t) - 2]), rng.randrange(3)
            t[k : k + 1] = [[], [rng.choice("xyz")], [t[k], "q"]][how]
        lines.append("".join(t))
    rows = [(i, "\n".join(lines[5 * i : 5 * i + 5])) for i in range(30)]
    got = duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.line_no) for r in got.collect()) == brute(rows)


def test_edit_automaton(spark):
    rng = random.Random(3)
    words = ["", "a", "b", "ab", "ba", "aab"] + ["".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(60)]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in df.select("a", "b", within_one_edit(F.col("a"), F.col("b")).alias("near")).collect():
        assert r.near == close(r.a, r.b), r


def test_whole_table_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((r.doc_id, r.line_no) for r in duplicate_lines(docs).collect()) == brute(rows)


def test_odd_rows_keep_their_columns(spark, odd_docs):
    out = dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r.text for r in rows}
    assert by[1] is None and by[2] == "" and by[4] == "one" and by[None] == "a text without any id at all"
    assert by[6] == "the same line of some words here\n"
    assert {r.doc_id: r.n_removed for r in line_report(odd_docs).collect()}[6] == 2
    assert dedup_lines(odd_docs.limit(0)).collect() == []


def test_rows_that_share_an_id_lose_only_their_own_lines(spark):
    rows = [(1, "A line that is shared\nunique line"), (1, "other\nA line that is shared"), (1, "other\nA line that is shared"), (2, "unique line\nmore")]
    out = [(r.doc_id, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    one = [t for i, t in out if i == 1]
    # the shared line stays in the text whose hash is smaller; equal rows are one document
    assert sorted(one) in (sorted(["A line that is shared\nunique line", "other", "other"]), sorted(["unique line", *["other\nA line that is shared"] * 2]))
    assert [t for i, t in out if i == 2] == ["more"]


def test_short_lines_repeat_only_when_equal(spark):
    rows = [(1, "Menu\nmenu \nMenus\n\n \n-"), (2, "-\nMENU\nHome")]
    got = duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.line_no) for r in got.collect()) == brute(rows) == [(1, 1), (2, 0), (2, 1)]


def test_columns_of_any_name_pass(spark):
    names = ["_removed", "_twin", "removed", "body", "line_no", "top", "at", "node", "first", "last", "again", "s", "whole", "len", "left", "right", "key", "side", "role", "Removed_", "_TWIN_"]
    docs = spark.createDataFrame([(1, "a line that is here twice\na line that is here twice", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for k, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(k))
    r = dedup_lines(docs).collect()[0]
    assert r.text == "a line that is here twice" and [r[c] for c in names] == list(range(len(names)))
    assert line_report(docs).collect()[0].removed_lines == "1"


def test_no_python_in_the_plan(spark, sf, capsys):
    line_report(spark.read.parquet(f"{sf}/documents.parquet")).explain()
    assert "Python" not in capsys.readouterr().out
