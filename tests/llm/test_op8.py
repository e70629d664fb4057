import random

import public_tokenizers
from pyrelake.llm.op8_token_counts import START, UNIT, VOCABULARY, Trie, Unigram, counted, op8_token_counts

model = Unigram(public_tokenizers.path(VOCABULARY))


def alone(word):
    """The same by a plain dynamic programme for one word."""
    best = [0]
    for at in range(len(word)):
        options = [best[a] + model.value[word[a : at + 1]] for a in range(at + 1) if word[a : at + 1] in model.value]
        if word[at] not in model.value:
            options.append(best[at] + len(word[at].encode("utf-8", "replace")) * model.byte)
        best.append(max(options))
    return -best[-1] % UNIT


def test_shared_prefixes_give_what_each_word_gives_alone():
    rng = random.Random(1)
    pieces = list(model.value)
    words = ["", "▁", "a", "▁the", "▁then", "▁thenx", "▁日本", "\U0001f600\U0001f600a", "é" * 40]
    words += ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 5))) for _ in range(1500)]
    words += ["▁" + "".join(rng.choice("etaoin字é\U0001f601") for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    assert Trie(words).counts(model) == {w: alone(w) for w in words} == {w: model.pieces(w) for w in words}


def test_tables(spark, sf, odd_docs):
    for df, rows in ((spark.read.parquet(f"{sf}/documents.parquet"), op8_token_counts(spark, sf).collect()), (odd_docs, counted(odd_docs).collect())):
        texts = [(r.doc_id, (r.text or "").split()) for r in df.collect()]
        kept = {w: alone(START + w) for _, t in texts for w in t}
        assert sorted(map(str, [(i, len(t), sum(map(kept.get, t))) for i, t in texts])) == sorted(str(tuple(r)) for r in rows)
    assert counted(odd_docs.limit(0)).collect() == []
