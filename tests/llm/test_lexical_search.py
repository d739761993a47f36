"""Lexical search against the formulas over all documents, and its edge cases."""

import random

import pytest

from tests.llm import brute
from tillmark.llm import lexical_search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def rows_of(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "aa", "b", "B", "été", "x1", "9", "中文", "long", "A.a", "it's", "é", " ", "x_y", ""]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", "  ", "-", "\n", "", "\x00"]) for _ in range(rng.randrange(k)))
    docs = [(i, text(30)) for i in range(n)] + [(None, "a b"), (None, None), (3, "a b"), (3, "a b"), (200, None), (201, " .,")]
    return docs, [(i, text(12)) for i in range(15)] + [(5, "a a b"), (6, None), (7, ""), (8, "nowhere"), (9, "a b")]


@pytest.mark.parametrize(("seed", "top", "block", "shares"), [(1, 50, 4_000_000, 64), (2, 3, 20, 2), (3, 1, 50, 1)])
def test_against_all_documents(spark, seed, top, block, shares):
    docs, items = corpus(seed)
    got = lexical_search.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), top,
                                block_chars=block, shares=shares)
    assert rows_of(got) == sorted(brute.search(docs, items, top), key=str)


def test_best_of_many_with_ties(spark, monkeypatch):
    """Many equal scores, and tasks that keep the best in many small steps."""
    docs = [(i, "a b" if i % 3 else "a") for i in range(500, 0, -1)]
    items = [(1, "a"), (2, "b a"), (3, "b")]
    got = lexical_search.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), 50)
    assert rows_of(got) == sorted(brute.search(docs, items), key=str)
    block = lexical_search.Block.of(items)
    weight = lexical_search.weights(block, 500, {0: 500, 1: 334})
    monkeypatch.setattr(lexical_search, "CELLS", 12)
    scorer = lexical_search.Scorer(block, weight, 500, 834, 50)
    for i, text in docs:
        scorer.add(i, text)
    scorer.settle()
    assert len(scorer.ids) <= 150
    mine = sorted((block.ids[n], scorer.ids[s], v) for n, s, v in zip(scorer.item, scorer.seat, scorer.score, strict=True))
    assert mine == sorted((i, d, s) for i, _, d, s in brute.search(docs, items))


def test_long_text_is_cut_between_terms(monkeypatch):
    automaton = lexical_search.Block.of([(1, "abc éé bc")]).automaton()
    text = "abc abc,bc ééé éé xabc BC " * 50
    whole = lexical_search.count_terms(automaton, text)
    assert whole[0] == 350 and sorted(whole[1].values()) == [50, 100, 100]
    for part in (1, 2, 7, 64):
        monkeypatch.setattr(lexical_search, "PART", part)
        assert lexical_search.count_terms(automaton, text) == whole


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5), (2, "c", "y", 6)], "doc_id long, text string, item string, score int")
    items = spark.createDataFrame([(1, "a", "z")], "item_id long, text string, rank string")
    assert rows_of(lexical_search.search(docs, items)) == sorted(brute.search([(1, "a b"), (2, "c")], [(1, "a")]), key=str)
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs.select("doc_id", docs.text.substr(9, 1).alias("text")), items).count() == 0
