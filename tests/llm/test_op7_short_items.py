import random

import pytest
from pyrelake.llm.op7_decontamination import Matcher, budget, contaminated, plain
from test_op7 import edited, least


def test_short_items_are_found_as_whole_words(spark):
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, "cat"), (3, "?!"), (2, "cat")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Q: what is the capital of FRANCE"), (2, "what is the capitol of france"), (3, "concatenate cats"), (4, "concat, a cat"), (5, "?!"), (6, "what was a capitol of frances")], "doc_id long, text string")
    assert sorted(tuple(r) for r in contaminated(docs, items).collect()) == [(1, 1, 0, 31), (2, 1, 1, 29), (4, 2, 0, 12)]


@pytest.mark.parametrize("seed", range(3))
def test_short_items_with_edits_match_brute_force(seed):
    rng = random.Random(seed)
    words = ["the", "capital", "of", "france", "is", "a", "large", "town", "rivers", "what"]
    items = [(k, plain(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))))) for k in range(40)]
    assert {budget(t) for _, t in items} >= {0, 1, 2}
    matcher = Matcher(items)
    for _ in range(60):
        body = plain(" ".join([*rng.choices(words, k=3), edited(rng, rng.choice([t for _, t in items if len(t) > 6]), rng.randrange(4)), *rng.choices(words, k=2)]))
        want = {}
        for k, t in items:
            d = least(f" {t} " if len(t) < 32 else t, f" {body} ")
            if d <= budget(t):
                want[k] = d
        assert {k: d for k, d, _ in matcher.find(body)} == want
