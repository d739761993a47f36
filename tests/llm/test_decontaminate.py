import random

from tests.conftest import FOLDER
from tests.llm import brute
from tillmark.llm import decontaminate


def test_best_end_against_table():
    rng = random.Random(4)
    for _ in range(200):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 70)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 90)))
        edits, end = decontaminate.best_end(decontaminate._masks(a), len(a), b, True)
        assert edits == brute.edit_distance(a, b, free_ends=True)
        if end:
            assert min(brute.edit_distance(a, b[s:end]) for s in range(end + 1)) == edits


def test_edited_passages_are_found(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrst"

    def text(n):
        return " ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(n))

    items = [(i, text(40)) for i in range(6)] + [(10, None), (11, ""), (12, "..."), (13, "Short item")]
    rows, expected = [], set()
    for number in range(60):
        body = text(60)
        if number % 2:
            key, item = items[number % 6]
            item = list(item)
            edits = rng.randrange(0, 2 * int(0.06 * len(item)))
            for _ in range(edits):
                item[rng.randrange(len(item))] = rng.choice(letters)
            body = f"{body}\n{''.join(item).upper()}, {text(20)}"
        rows.append((number, body))
    rows += [(100, None), (101, ""), (102, "the SHORT, item!"), (103, items[0][1] + " " + items[1][1]), (103, items[0][1])]
    for i, t in rows:
        expected |= {(i, k) for k, item in items if item and t and brute.holds(t, item)}
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, edits int, m string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (4_000_000, 300):
        found = decontaminate.leaks(docs, benchmark, block_chars=block_chars).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in expected}


def test_whole_items_of_the_test_table(spark):
    docs, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: " ".join(brute.words(r.text)) for r in benchmark.collect()}
    texts = {r.doc_id: " ".join(brute.words(r.text)) for r in docs.collect()}
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(docs, benchmark).collect()}
    exact = {(i, k) for i, t in texts.items() for k, x in items.items() if x in t}
    assert exact and exact == {k for k, edits in found.items() if edits == 0}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark).count() == 1
    some = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert decontaminate.leaks(docs.limit(0), some).count() == 0
