import zlib

import numpy as np
import public_tokenizers
import pytest
from pyrelake.llm import op2_token_files as op2
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(public_tokenizers.path(op2.VOCABULARY))


def brute(lib, rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_whole_table_reads_back_what_the_library_gives(spark, sf, lib, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(lib, [(r.doc_id, r.text) for r in docs.collect()])
    assert order(op2.op2_token_files(spark, sf).collect()) == want


def test_many_small_files_and_single_documents(spark, sf, lib, tmp_path, monkeypatch):
    monkeypatch.setattr(op2, "FILE_BYTES", 20_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    listed = op2.write(docs, f"file://{tmp_path}")
    rows = sorted(listed.collect(), key=lambda r: r.first)
    texts = [r.text for r in sorted(docs.collect(), key=lambda r: r.doc_id)]
    reader = op2.Reader(next(tmp_path.glob("*.dictionary")).read_bytes())
    for r in rows:
        for k in {0, r.documents // 2, r.documents - 1}:
            assert reader.document(r.uri, k).tolist() == [*lib.encode(texts[r.first + k], add_special_tokens=False).ids, 1]
    with pytest.raises(IndexError):
        reader.document(rows[0].uri, rows[0].documents)
    with pytest.raises(ValueError):
        op2.Reader(b"").document(rows[0].uri, 0)


def test_odd_rows(spark, odd_docs, lib, tmp_path):
    got = op2.read(op2.write(odd_docs, f"file://{tmp_path}"), f"file://{tmp_path}")
    assert order(got.collect()) == brute(lib, [(r.doc_id, r.text) for r in odd_docs.collect()])
    none = f"file://{tmp_path}/none"
    assert op2.read(op2.write(odd_docs.limit(0), none), none).collect() == []


def test_chunks_that_hold_the_mark(lib):
    texts = ["a\x00b c", "\x00", "x \x00 y", "İ ΣΑΣ <|endoftext|>z \x00", "w\x1cv"]
    got = [np.frombuffer(x, "<u2").tolist() for x in op2.serialized(texts, end=None)]
    assert got == [lib.encode(x, add_special_tokens=False).ids for x in texts]


def test_any_mixture_of_characters(lib):
    """Chunks kept, folded and joined give what the library gives for the whole text; the automaton's as well."""
    import random

    from pyrelake.llm.op4_bpe import _joined, _kept, vocabulary

    rng = random.Random(11)
    some = [*"abcdefghijklmnopqrstuvwxyzABCDEFXYZ", *"éÉüßñİıΣσςǅ中\u0301Åﬁ１²", *"'.,;:!?*$%&#|<>-_@0123 \n\t", "'s", "'LL", "<|endoftext|>", "***", "  ", "\x00", "\x1d", "\u2028", "\x85"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(4000)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in op2.serialized(texts, end=None)] == want
    assert [_joined(x).tolist() for x in _kept(vocabulary(), True).of(texts)] == want


def test_tokenizers_that_keep_white_space_read_texts_whole():
    name, texts = "byte_bpe_50k.json", ["Some words,  and\n\nmore", "", None, " x"]
    t = Tokenizer.from_file(public_tokenizers.path(name))
    got = [np.frombuffer(x, "<u2").tolist() for x in op2.serialized(texts, name, 7)]
    assert got == [[*t.encode(x or "", add_special_tokens=False).ids, 7] for x in texts]


def test_chunks_that_come_again_are_looked_up_once_in_a_group(lib, monkeypatch):
    """What a text costs is its distinct chunks' look-ups and not all chunks'."""
    asked, values = [], op2.Kept.values
    monkeypatch.setattr(op2.Kept, "values", lambda self, distinct: asked.extend(distinct) or values(self, distinct))
    texts = [f"Some words come again, {k % 7} times\tor more. " * 50 for k in range(300)]
    got = [np.frombuffer(x, "<u2").tolist() for x in op2.serialized(texts, end=None)]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert len(asked) == len(set(asked)) < 20


def test_words_of_latin_letters_take_the_short_way(lib, monkeypatch):
    """Only chunks with something else in them are normalized and pre-split by the library."""
    t, slow = lib, []

    def together(new):
        slow.extend(new)
        return [np.array(e.ids, "<u2").tobytes() for e in t.encode_batch_fast(new, add_special_tokens=False)]

    make = op2._plain(t, together, 2)
    slow.clear()
    new = ["Ab", "\u00e9t\u00e9", "\u00c9T\u00c9", "stra\u00dfe", "\u0130x", "x1", "a,b", "\u01c5", "\u023a", "\u03a3a", "", "a\u0301", "'s", "\u00aa\u00ba\u00b5", "w" * 300]
    assert [np.frombuffer(x, "<u2").tolist() for x in make(new)] == [lib.encode(x, add_special_tokens=False).ids for x in new]
    assert slow == ["\u0130x", "x1", "a,b", "\u023a", "\u03a3a", "", "a\u0301", "'s"]


def test_groups_of_any_size_and_texts_that_arrow_splits_elsewhere(lib, monkeypatch):
    texts = ["", None, " \n", "a\x1cb c", "D\x1f", "<|endoftext|>E <|ENDOFTEXT|>", "\u03a3\u0391\u03a3 x", "f\x85g\u3000h", None, "i" * 100, "\x1d \x1e", "j k " * 40]
    want = [lib.encode(x or "", add_special_tokens=False).ids for x in texts]
    for size in (1, 10, 1 << 20):
        monkeypatch.setattr(op2, "GROUP", size)
        for kept in (texts, op2.pa.array([None, *texts, ""])[1:-1]):
            assert [np.frombuffer(x, "<u2").tolist() for x in op2.serialized(kept, end=None)] == want
    assert list(op2.serialized([])) == []
