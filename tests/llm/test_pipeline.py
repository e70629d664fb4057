"""The stages one after another, each held against a plain version of its decision on what it was given."""

import hashlib

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from pyrelake.llm.op4_bpe import vocabulary
from pyrelake.llm.op5_simhash import fingerprint
from pyrelake.llm.op7_decontamination import budget, plain
from pyrelake.llm.op10_language import train
from test_near_copies import brute as near
from test_op7 import least
from test_op9 import brute as repeated
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """The documents, and after each stage; as the stages' callers do, written and read again."""
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(steps):
    assert [n for n, _ in cp.STAGES] == ["language", "line_dedup", "simhash", "decontamination", "bpe"]
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_language_keeps_what_it_can_name(steps):
    net, docs = train(steps[0]), texts(steps[0])
    said = dict(zip(docs, net.predict(list(docs.values())), strict=True))
    assert texts(steps[1]) == {i: t for i, t in docs.items() if said[i][0] != "und" and said[i][1] >= cp.LEAST_SCORE}
    assert len(texts(steps[1])) >= 0.98 * len(docs)


def test_lines(steps):
    docs = texts(steps[1])
    gone = set(repeated(list(docs.items())))
    left = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in docs.items()}
    assert texts(steps[2]) == {i: t for i, t in left.items() if t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_one_of_each_group_stays(steps):
    docs = texts(steps[2])
    rows = list(docs.items())
    name = near(rows)
    prints = [(i, fingerprint(t, 5)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(prints) for j, b in prints[:k] if ((a ^ b) % 2**64).bit_count() <= 2]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if name[i] != name[j]:
                old, new = max(name[i], name[j]), min(name[i], name[j])
                name, changed = {k: new if v == old else v for k, v in name.items()}, True
    assert set(texts(steps[3])) == set(name.values())


def test_leaks_go(spark, sf, steps):
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    for i, t in before.items():
        if i not in after:
            assert any(least(x, plain(t)) <= budget(x) for x in items)
        else:
            assert not any(x in plain(t) for x in items)


def test_tokens(steps):
    lib, docs = Tokenizer.from_file(vocabulary()), texts(steps[4])
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, sf, steps):
    assert sorted((r.doc_id, r.ids_sha256) for r in cp.run(spark, sf).collect()) == sorted((r.doc_id, r.ids_sha256) for r in steps[5].collect())


def test_odd_rows(spark, sf, odd_docs):
    docs = odd_docs
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), sf).collect() == []
        out = stage(spark, docs, sf)
        assert name == "bpe" or out.columns == docs.columns
        out.collect()


def test_columns_of_any_name_pass_and_equal_rows_are_one(spark, sf):
    words = "enough plain words of a text that stands here and says what it is about"
    rows = [(1, words, "en", "s", 9), (1, words, "en", "s", 9), (1, words + " or not, as the case may be with other words behind it altogether", "en", "s", 9), (2, words.upper(), "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["said", "_said", "leaks", "_leaks", "body", "_twin", "removed", "component", "node", "count"]
    for k, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(k))
    out = docs
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns and all([r[c] for c in names] == list(range(len(names))) for r in out.collect()), name
    alone = cp.distinct_documents(spark, docs, sf).collect()
    assert sorted((r.doc_id, len(r.text)) for r in alone) == sorted({(1, len(rows[0][1])), (1, len(rows[2][1]))})
