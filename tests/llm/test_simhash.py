"""SimHash fingerprints bit by bit, links and components against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tests.llm import brute
from tillmark.llm import simhash
from tillmark.llm.queries import LLM_QUERIES

TEXTS = [None, "", " \t\r\n\x0b\x0c", "one", "One TWO", "a b c", "a  b\tc D", "Ä ä ẞ  x y z", "w " * 40,
         "x" * 5000, "a\x00b c d e"]


def unsigned(value):
    return value & (1 << 64) - 1


def test_fingerprint_bit_by_bit():
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice(["a", "Bc", "dé", "\t", ""]) for _ in range(rng.randrange(60))) for _ in range(300)]
    assert [unsigned(simhash.fingerprint(t)) for t in texts] == [brute.fingerprint(t) for t in texts]


def test_long_text_in_parts(monkeypatch):
    rng = random.Random(6)
    text = " ".join(str(rng.randrange(500)) for _ in range(2_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART", 7)
    assert simhash.fingerprint(text) == whole
    assert unsigned(whole) == brute.fingerprint(text)
    assert simhash.fingerprint("word " * 1_000_000) == simhash.fingerprint("word " * 4)


@pytest.mark.parametrize(("blocks", "most"), [(5, 4), (6, 4), (7, 4), (9, 4), (4, 2)])
def test_close_pairs_agree_in_a_choice(blocks, most):
    rng = random.Random(7)
    chosen = simhash.masks(blocks, most)
    for _ in range(2_000):
        flip = sum(1 << b for b in rng.sample(range(64), most))
        assert any(flip & unsigned(m) == 0 for m in chosen)


def test_number_of_blocks():
    assert [simhash.blocks_for(n, 4) for n in (0, 1, 2_000, 100_000, 500_000, 10**7, 10**9, 10**12)] == [5, 5, 6, 6, 6, 7, 8, 8]
    assert len(simhash.flips(2)) == len(set(simhash.flips(2))) == 2_081


def nodes_around(rng, count):
    centres = [rng.getrandbits(64) for _ in range(6)]
    near = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(count)]
    return sorted({*near, *(rng.getrandbits(64) for _ in range(count // 4)), 0, 1, (1 << 64) - 1})


@pytest.mark.parametrize(("whole", "blocks"), [(4096, None), (4096, 8), (3, None), (1, 6)])
def test_components_of_random_nodes(spark, tmp_path, whole, blocks):
    """Small limits send the nodes through the points between them."""
    nodes = nodes_around(random.Random(whole), 160)
    frame = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "node long")
    frame.write.parquet(str(tmp_path / "nodes"))
    links = simhash.close_links(spark.read.parquet(str(tmp_path / "nodes")), whole=whole, blocks=blocks)
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() <= 4 for r in links.distinct().collect())
    roots = {unsigned(r.node): unsigned(r.root) for r in simhash.components(links).collect()}
    expected = brute.bit_components([(n, n) for n in nodes])
    groups = {}
    for n in nodes:
        groups.setdefault(roots.get(n, n), set()).add(n)
    wanted = {}
    for n, first in expected.items():
        wanted.setdefault(first, set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    prints = {i: brute.fingerprint(t) for i, t in docs}
    roots = brute.bit_components(list(prints.items()))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in LLM_QUERIES["op12_simhash"](spark, FOLDER).collect()}
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i, _ in docs}
    assert len(set(roots.values())) < len(docs)


def test_edge_rows(spark):
    """Null ids and texts, repeated rows, clashing columns, empty table."""
    rows = [(5, None), (9, ""), (None, " "), (3, "a b c d e"), (3, "a b c d e"), (None, "only without id x y z"), (8, "a b  c\nD e")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, `component_id` string")
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicate_components(docs).collect()]
    assert sorted(got, key=str) == sorted([(5, 5), (9, 5), (None, 5), (3, 3), (3, 3), (None, None), (8, 3)], key=str)
    assert simhash.near_duplicate_components(docs.limit(0)).count() == 0


def test_work_of_a_hot_group_is_bounded(spark, tmp_path):
    """Nodes that share a large bucket become rows in proportion to their number, not pairs."""
    sizes = []
    for count in (200, 400):
        folder = str(tmp_path / str(count))
        spark.range(count).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))).alias("node")).write.parquet(folder)
        links = simhash.close_links(spark.read.parquet(folder), whole=16, blocks=5)
        sizes.append(links.count())
    assert sizes[1] <= 3 * max(sizes[0], 10)
