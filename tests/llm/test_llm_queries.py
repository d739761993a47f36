"""The registered queries against SQL or plain Python, and the pipeline against plain stages."""

import importlib

import pytest

import corpus_pipeline
from tests.compare import difference, duck
from tests.conftest import FOLDER
from tests.llm import brute
from tillmark.llm import mixing, toxicity
from tillmark.llm.queries import LLM_ORACLE, LLM_QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_same_as_sql(spark, con, name):
    assert difference(LLM_QUERIES[name](spark, FOLDER), con, LLM_ORACLE[name]) is None


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in LLM_QUERIES) == list(range(1, 14))


@pytest.mark.parametrize(("name", "table", "column"), [
    ("op1_html_text", "pages", "page_id"), ("op2_toxicity", "documents", "doc_id"), ("op8_order_minhash", "documents", "doc_id"),
    ("op10_pii", "documents", "doc_id")])
def test_one_row_per_row(spark, name, table, column):
    ids = sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(column).collect())
    assert sorted(r[0] for r in LLM_QUERIES[name](spark, FOLDER).select(column).collect()) == ids


def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    left = {r.doc_id: r for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    keep = {}
    for i, r in left.items():
        keep[brute.lowered(r.text)] = max(i, keep.get(brute.lowered(r.text), i))
    left = {i: r for i, r in left.items() if keep[brute.lowered(r.text)] == i}
    classes = brute.near_classes([(i, r.text) for i, r in left.items()])
    left = {i: r for i, r in left.items() if classes[i] == i}
    items = [" ".join(brute.words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    plain = {i: " ".join(brute.words(r.text)) for i, r in left.items()}
    left = {i: r for i, r in left.items() if not any(x and x in plain[i] for x in items)}
    rest = docs.where(docs.doc_id.isin(list(left)))
    expected = {(r.doc_id, r.mix_epoch) for r in mixing.mix(rest, max_repeats=2.0).collect()}
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == [*docs.columns, "mix_epoch", "mix_block", "mix_place"]
    assert {(r.doc_id, r.mix_epoch) for r in got.collect()} == expected
    assert {i for i, e in expected if e == 1} == set(left)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stage_keeps_the_columns(spark, name, stage):
    docs = spark.createDataFrame(
        [(1, "a text of some words that stays", "en", "s", None), (None, None, None, None, 0)],
        spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    assert sorted(stage(spark, docs, FOLDER).columns) == sorted(docs.columns)
    assert stage(spark, docs, FOLDER).count() == 2
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
