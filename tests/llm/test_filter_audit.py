"""The filter audit against running every order of the filters, and its edge cases."""

import random
from collections import Counter

import pytest

from tests.llm import brute
from tillmark.llm import filter_audit

KINDS = "doc_id long, text string, source string"
MARKS = "doc_id long, quality int, toxic int"


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "A", "a$b", "éé É" * 90, "x " * 250, " ".join(f"w{i}" for i in range(220)),
             "\x0bLEAD " + " ".join(f"W{i}" for i in range(230)), " ".join(f"w{i % 150}" for i in range(300)) + " 5 %"]
    texts += ["".join(rng.choice("aB c\t#") for _ in range(rng.randrange(9))) for _ in range(12)]
    docs = [(rng.choice([None, *range(90)]), rng.choice(texts), rng.choice([None, "", "s", "t"])) for _ in range(n)]
    labels = [(rng.choice([None, *range(90)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1, 2])) for _ in range(80)]
    return docs, labels


def rows_of(frame):
    return Counter(tuple(r[c] for c in ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                        "good_lost", "toxic_lost", "shapley")) for r in frame.collect())


@pytest.mark.parametrize("seed", [3, 4])
def test_against_every_order(spark, seed):
    docs, labels = corpus(seed)
    got = filter_audit.audit(spark.createDataFrame(docs, KINDS), spark.createDataFrame(labels, MARKS))
    assert rows_of(got) == Counter(brute.audit(docs, labels))


def test_hot_text_and_clashing_columns(spark):
    """A text that fills most of the table; extra columns with the names used inside."""
    docs = [(i, "same words", "s") for i in range(300)] + [(0, "same words", "s"), (7, "other", None)]
    frame = spark.createDataFrame([(*d, 1, "x", 2, "a") for d in docs], f"{KINDS}, n int, mask string, part int, `least.doc_id` string")
    marks = spark.createDataFrame([(0, 1, 0, "x"), (5, 1, 1, "y")], f"{MARKS}, n string")
    assert rows_of(filter_audit.audit(frame, marks)) == Counter(brute.audit(docs, [(0, 1, 0), (5, 1, 1)]))


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a", "s")], KINDS), spark.createDataFrame([], MARKS)
    assert filter_audit.audit(docs.limit(0), none).count() == 0
    assert filter_audit.audit(docs, none).count() == 600


def test_other_filters_and_column_names(spark):
    docs = spark.createDataFrame([(1, "ab", "s"), (2, "b", "s"), (3, "b", "s")], "id long, `the.text` string, `a part` string")
    marks = spark.createDataFrame([], MARKS)
    got = filter_audit.audit(docs, marks, "id", "the.text", "a part", {"X": lambda t: t.contains("a"), "Y": lambda t: t.contains("b")})
    rows = {(r.filter_order, r.step): r for r in got.collect()}
    assert len(rows) == 18
    assert (rows["XYE", 1].removed, rows["XYE", 2].removed, rows["XYE", 3].removed) == (1, 2, 0)
    assert rows["EXY", 1].removed == 1 and rows["EXY", 1].redundant == 0
    # X shares document 1 with Y: half a document each, over 6 orders 3; Y has 2 more of which one is shared with E
    assert [rows[o, 1].shapley for o in ("XYE", "YXE", "EXY")] == [3, 12, 3]
    with pytest.raises(ValueError):
        filter_audit.audit(docs, marks, "id", "the.text", "a part", {"E": lambda t: t.contains("a")})


def test_long_text(spark):
    docs = [(1, "Word " * 400_000 + "$", "s")]
    got = filter_audit.audit(spark.createDataFrame(docs, KINDS), spark.createDataFrame([(1, 1, 1)], MARKS))
    assert rows_of(got) == Counter(brute.audit(docs, [(1, 1, 1)]))
