from collections import defaultdict

from tests.llm.brute import lowered
from tillmark.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    return {(i, max((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g}


def test_decisions(spark):
    rows = [(i, f"Text {i % 40}") for i in range(400)] + [(1000 + i, "HOT text é") for i in range(300)]
    rows += [(2000, None), (2001, ""), (2002, "É"), (2003, "é"), (None, "text 3"), (2005, "x" * 300_000), (2006, "X" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    for tracked in (8192, 8):  # a small summary misses groups; the result stays the same
        found = exact_dedup.dedup_decisions(docs, tracked=tracked).collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == expected(rows)
        assert len(found) == len(rows)
        assert {r.doc_id for r in found if r.kept} == {k for _, k, _ in expected(rows)}


def test_kept_rows_with_clashing_columns(spark):
    names = "doc_id long, text string, digest string, row int, winner int, keep_id int, rank int, known int"
    rows = [(1, "A", "d", 1, 1, 1, 1, 1), (2, "a", "d", 1, 1, 1, 1, 1), (2, "a", "d", 1, 1, 1, 1, 1), (None, None, None, 5, 5, 5, 5, 5),
            (3, "", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, names)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {rows[1], rows[4]}
    assert kept.count() == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.dedup_decisions(docs).count() == exact_dedup.drop_exact_copies(docs).count() == 0


def test_only_plain_functions(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    for df in (exact_dedup.dedup_decisions(docs), exact_dedup.drop_exact_copies(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_names_with_dots(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "A", 1)], "`doc.id` long, `a.text` string, doc long")
    found = exact_dedup.dedup_decisions(docs, "doc.id", "a.text").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {(1, 2, False), (2, 2, True)}
    assert [tuple(r) for r in exact_dedup.drop_exact_copies(docs, "doc.id", "a.text").collect()] == [(2, "A", 1)]
