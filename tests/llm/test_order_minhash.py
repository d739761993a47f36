import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from tests.conftest import FOLDER
from tests.llm import brute
from tillmark.llm import components as stars
from tillmark.llm import order_minhash
from tillmark.llm.components import components


TENTH = "/root/testdata/sf0.01"


def planted():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]

    def text(n):
        return " ".join(rng.choices(vocabulary, k=n))

    rows, number = [], iter(range(10_000))
    hot, passage = text(80).split(), text(55)
    for _ in range(120):  # one large group of near copies
        copy = list(hot)
        copy[rng.randrange(80)] = rng.choice(vocabulary)
        rows.append((next(number), " ".join(copy)))
    rows += [(next(number), " ".join(hot)) for _ in range(40)]
    rows += [(next(number), f"{text(60)} {passage} {text(60)}") for _ in range(60)]  # one passage in unlike texts
    for _ in range(20):
        base = text(100).split()
        rows.append((next(number), " ".join(base)))
        rows.append((next(number), " ".join(base[:40] + ["new", "words"] + base[40:]).upper()))
        rows.append((next(number), " ".join(base[50:] + base[:50])))  # the same words in another order
        rows.append((next(number), " ".join(base[::2])))
    rows += [(next(number), t) for t in ("", None, "!!", "one two", "One, two!", "one two three", "a", "a", text(6000))]
    return rows


@pytest.fixture(scope="module")
def rows():
    return planted()


def test_same_classes_as_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = order_minhash.near_duplicate_classes(docs).collect()
    expected = brute.near_classes(rows)
    assert {r.doc_id: r.class_id for r in found} == expected
    sizes = {k: list(expected.values()).count(k) for k in expected.values()}
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in found)


def test_same_classes_on_the_test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicate_classes(docs).collect()}
    assert found == brute.near_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(5, text, 1, "x"), (None, text, 1, "x"), (7, text + " end", None, None), (7, text + " end", None, None), (8, None, 3, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, class_id string")
    kept = order_minhash.drop_near_copies(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {5, None, 8}
    assert order_minhash.near_duplicate_classes(docs.limit(0)).count() == 0


def test_repeated_ids(spark):
    text, other, third = (" ".join(f"{c}{i}" for i in range(30)) for c in "vxy")
    rows = [(5, text, 1), (7, text + " end", 2), (7, other, 3), (8, third, 4), (8, third, 5), (9, third + " end", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = [(r.doc_id, r.text) for r in order_minhash.drop_near_copies(docs).collect()]
    assert sorted(kept) == sorted([(5, text), (7, other), (8, third)])


def test_alignment_against_table():
    rng = random.Random(9)
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        b = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        limit = rng.randrange(0, 8)
        assert order_minhash.edits_within(a, b, limit) == (brute.edit_distance(a, b) <= limit)


def test_alignment_of_longer_texts():
    """Bands that are wider and narrower than the distance, and masks that are built anew along the text."""
    rng = random.Random(10)
    for _ in range(30):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(40, 120))]
        b = list(a)
        for _ in range(rng.randrange(1, 40)):
            place = rng.randrange(len(b))
            b[place:place + rng.randrange(2)] = rng.choice(["", "a", "bc"])
        distance = brute.edit_distance(a, b)
        for limit in (0, distance - 1, distance, distance + 1, 50):
            assert order_minhash.edits_within(a, b, max(limit, 0)) == (distance <= max(limit, 0))


def test_the_count_of_shared_runs_rules_out_no_close_pair():
    rng = random.Random(12)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(14)):
            place = rng.randrange(len(b) + 1)
            b[place:place + rng.randrange(2)] = rng.choice([[], ["a"], ["x"]])
        assert order_minhash.near_copies(a, b, 0.8) == brute.near(" ".join(a), " ".join(b))


def test_very_long_texts_are_aligned_in_a_band():
    rng = random.Random(13)
    a = [str(rng.randrange(5_000)) for _ in range(40_000)]
    b = [w if rng.random() > 0.05 else "new" for w in a]
    assert order_minhash.near_copies(a, b, 0.8)
    assert not order_minhash.near_copies(a, b, 0.99)


@pytest.mark.parametrize(("share", "least"), [(0.02, 0.99), (0.05, 0.99), (0.1, 0.85)])
def test_recall_by_edits(share, least):
    """Pairs with a share of their words replaced that meet in a bucket; the bound is below the docstring's formula."""
    rng = random.Random(int(share * 100))
    seeds = order_minhash.mix(order_minhash.np.arange(1, 33, dtype="uint64") * order_minhash.GOLDEN) | order_minhash.np.uint64(1)

    def keys(words):
        return set(order_minhash.order_sketch(order_minhash.labelled(order_minhash.shingle_hashes(
            order_minhash.word_hashes(words))), seeds, 3).tolist())

    met = 0
    for _ in range(300):
        a = [str(rng.randrange(3_000)) for _ in range(rng.choice((100, 200, 600)))]
        changed = set(rng.sample(range(len(a)), round(share * len(a))))
        b = ["new" if i in changed else w for i, w in enumerate(a)]
        met += bool(keys(a) & keys(b))
    assert met / 300 >= least


def test_recall_on_the_test_table(spark):
    """Of all pairs of different texts with an edit similarity of 0.9 or more, at least 0.9 are in one class, and no pair
    below 0.8 makes a class of its own."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TENTH}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicate_classes(spark.read.parquet(f"{TENTH}/documents.parquet")).collect()}
    held, holders = {i: brute.words(t) for i, t in docs}, {}
    for i, ws in held.items():
        for k in range(len(ws) - 2):
            holders.setdefault(tuple(ws[k:k + 3]), []).append(i)
    shared = Counter((a, b) for ids in holders.values() for a in set(ids) for b in set(ids) if a < b)
    close = [(a, b) for (a, b), n in shared.items() if held[a] != held[b] and min(len(held[a]), len(held[b])) >= 10
             and n >= 0.2 * max(len(held[a]), len(held[b])) and brute.near(docs[a][1], docs[b][1], 0.9)]
    assert len(close) > 50
    assert sum(found[a] == found[b] for a, b in close) >= 0.9 * len(close)
    groups = {}
    for i, root in found.items():
        groups.setdefault(root, []).append(i)
    for members in groups.values():
        joined = {members[0]}
        while more := [i for i in members if i not in joined and any(
                docs[i][1] == docs[j][1] or order_minhash.near_copies(held[i], held[j], 0.8) for j in joined)]:
            joined |= set(more)
        assert joined == set(members)


@pytest.mark.parametrize("chunk", [7, 50])
def test_components_of_chunks(spark, monkeypatch, chunk):
    """Links beyond a chunk go through rounds of stars, up to a chunk through none; the roots are the same."""
    rounds, star = [], stars._large_star
    monkeypatch.setattr(stars, "CHUNK", chunk)
    monkeypatch.setattr(stars, "_large_star", lambda edges: rounds.append(1) or star(edges))
    links = [(bytes([i]), bytes([i + 1])) for i in range(20)] + [(b"z", bytes([200 + i])) for i in range(10)] + [(b"x", b"x")]
    found = [(bytes(r.node), bytes(r.root)) for r in components(spark.createDataFrame(links, "a binary, b binary").repartition(3)).collect()]
    assert sorted(found) == sorted([(bytes([i]), bytes([0])) for i in range(21)] + [(b"z", b"z")] + [(bytes([200 + i]), b"z") for i in range(10)])
    assert bool(rounds) == (chunk < len(links))


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(500 + i, 500 + rng.randrange(i + 1)) for i in range(50)]
    found = {(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(61)} | {(100 + i, 100) for i in range(80)} | {
        (i, min(j for j in range(500, 550) if j in group)) for group in _groups(links) for i in group if i >= 500}


def _groups(links):
    groups = []
    for a, b in links:
        if a == b:
            continue
        joined = [g for g in groups if a in g or b in g]
        groups = [g for g in groups if g not in joined] + [{a, b}.union(*joined)]
    return groups


def edited_copies(number, size=100, words=300, seed=11):
    """An original, and ``number`` copies with 5 or 6 of its words changed: most copies link to the original only."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=words)
    rows = [(size, " ".join(base))]
    for i in range(number):
        copy = list(base)
        for at in rng.sample(range(10, words - 10), rng.choice((5, 6))):
            copy[at] = rng.choice(vocabulary)
        rows.append((size + 1 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("central", [True, False])
def test_copies_of_one_original(spark, monkeypatch, central):
    rows = edited_copies(300)
    if not central:  # a leader picked at random: the rest is left to the full comparison
        monkeypatch.setattr(order_minhash, "CELL_NODES", 40)
        monkeypatch.setattr(order_minhash, "_led", lambda members: members.groupBy("key").agg(
            F.min(F.struct("digest", "n")).alias("first")).select("key", "first.digest", "first.n").toDF("key", "leader", "leader_n"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicate_classes(docs).collect()}
    assert found == brute.near_classes(rows)
    assert len(set(found.values())) < 10


def test_pipeline_stage_on_copies_of_one_original(spark):
    rows = edited_copies(400, seed=12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()}
    assert kept == set(brute.near_classes(rows).values())


def test_two_rounds_whatever_the_group(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(order_minhash, "components", lambda links: rounds.append(1) or components(links))
    docs = spark.createDataFrame(edited_copies(150, seed=13), "doc_id long, text string").repartition(7)
    assert order_minhash.near_duplicate_classes(docs).count() == 151
    assert len(rounds) <= 2


def test_pairs_of_several_buckets_meet_in_the_first(monkeypatch):
    """Over all buckets, links join the same nodes as all pairs that share a bucket, and no pair is aligned twice."""
    rows = [(bytes([i]), text) for i, (_, text) in enumerate(edited_copies(40, words=60, seed=14))]
    rng = random.Random(15)
    held = {digest: sorted(rng.sample(range(6), 3)) for digest, _ in rows}
    aligned = Counter()
    real = order_minhash.near_copies

    def counted(a, b, threshold):
        aligned[frozenset((" ".join(a), " ".join(b)))] += 1
        return real(a, b, threshold)

    monkeypatch.setattr(order_minhash, "near_copies", counted)
    links = []
    for key in range(6):
        inside = [(d, d, text, [k for k in held[d] if k < key], 0) for d, text in rows if key in held[d]]
        links += order_minhash.links_between(pd.DataFrame(inside, columns=["digest", "own", "text", "earlier", "side"]), 0.9)
    wanted = [(a, b) for a, x in rows for b, y in rows if a < b and set(held[a]) & set(held[b])
              and real(brute.words(x), brute.words(y), 0.9)]
    assert wanted and max(aligned.values()) == 1
    assert {frozenset(g) for g in _groups(links)} == {frozenset(g) for g in _groups(wanted)}


def test_alike_ends_need_no_alignment(monkeypatch):
    """Words that two texts begin and end with alike are cut off before the alignment, and the edits stay the same."""
    rng, widths = random.Random(16), []
    real = order_minhash.banded_distance
    monkeypatch.setattr(order_minhash, "banded_distance", lambda a, b, band: widths.append(max(len(a), len(b))) or real(a, b, band))
    tail = [str(rng.randrange(500)) for _ in range(600)]
    texts = [[str(rng.randrange(60)) for _ in range(rng.randrange(100, 190))] + tail for _ in range(8)]
    for a in texts:
        for b in texts:
            assert order_minhash.near_copies(a, b, 0.8) == (brute.edit_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))
    assert widths and max(widths) < 190
    for _ in range(200):
        a, b = ([rng.choice("ab") for _ in range(rng.randrange(9))] for _ in range(2))
        assert brute.edit_distance(a, b) == brute.edit_distance(*order_minhash.trimmed(a, b))


def test_texts_whose_pairs_are_settled_are_not_read(monkeypatch):
    """Nodes of one class, or that all share an earlier bucket, are not split into words; a pair in one cell is aligned once."""
    split, aligned = [], Counter()
    monkeypatch.setattr(order_minhash._terms, "of", lambda text, of=order_minhash._terms.of: split.append(text) or of(text))
    monkeypatch.setattr(order_minhash, "near_copies", lambda a, b, t: aligned.update([frozenset((a[-1], b[-1]))]))
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(bytes([i]), own, f"{base} {i}", earlier, 0) for i, (own, earlier) in enumerate(
        [(b"p", [1]), (b"q", [1]), (b"r", [1, 2]), (b"p", [2]), (b"p", [1, 2])])]
    assert order_minhash.links_between(pd.DataFrame(rows, columns=["digest", "own", "text", "earlier", "side"]), 0.8) == []
    assert aligned == {frozenset("13"): 1}
    assert sorted(split) == [f"{base} 1", f"{base} 3"]
