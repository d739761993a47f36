import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillmark.llm import mixing

ROWS = (
    [(i, "hot", "one two three four " * (1 + i % 7)) for i in range(600)]
    + [(1000 + i, f"s{i % 5}", "a b c " * (1 + i % 3)) for i in range(200)]
    + [(2000 + i, None, "x y") for i in range(30)] + [(3000, "blank", ""), (3001, "blank", None), (3002, "s0", None), (None, "s1", "null id here")])


def tokens(text):
    return len((text or "").split())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, source string, text string, room int, its_source int").repartition(5)


def totals_of(rows):
    out = defaultdict(int)
    for _, s, t in rows:
        out[s] += tokens(t)
    return out


@pytest.mark.parametrize("goal", [{"max_repeats": 2.0}, {"max_repeats": None, "entropy": 1.2}, {"max_repeats": 3.0, "budget_tokens": 2500.0}])
def test_mixture_meets_its_plan(spark, docs, goal):
    totals = totals_of(ROWS)
    used = {s: n for s, n in totals.items() if n}
    found = mixing.find_exponent(
        spark.createDataFrame(list(totals.items()), "source string, tokens long"), goal.get("entropy"),
        None if "entropy" in goal else goal["max_repeats"])
    raised = {s: n ** found.exponent for s, n in used.items()}
    weight = {s: r / sum(raised.values()) for s, r in raised.items()}
    if "entropy" in goal:
        assert abs(-sum(w * math.log(w) for w in weight.values()) - goal["entropy"]) < 1e-6
    else:
        assert abs(max(used.values()) ** (1 - found.exponent) / min(used.values()) ** (1 - found.exponent) - goal["max_repeats"]) < 1e-6
    budget = goal.get("budget_tokens") or max(used.values()) / max(weight.values())
    got = mixing.mix(docs, **goal)
    assert got.columns == [*docs.columns, "mix_epoch", "mix_block", "mix_place"]
    uses = defaultdict(lambda: defaultdict(list))
    for r in got.collect():
        uses[r.source][r.mix_epoch].append((r.doc_id, tokens(r.text)))
    for source, total in used.items():
        repeats = round(weight[source] * budget / total, 9)
        full = math.floor(repeats)
        everything = sorted(((i, tokens(t)) for i, s, t in ROWS if s == source), key=str)
        for epoch in range(1, full + 1):
            assert sorted(uses[source][epoch], key=str) == everything
        part = math.floor((repeats - full) * total)
        last = sum(n for _, n in uses[source].get(full + 1, []))
        assert last <= part and part - last < max(n for _, n in everything)
        assert max(uses[source], default=0) <= full + 1
    if "budget_tokens" not in goal:
        assert sorted(i for i, _ in uses["blank"][1]) == [3000, 3001]


def test_last_round_is_a_prefix_of_its_permutation(docs):
    got = mixing.mix(docs, max_repeats=2.0).where("mix_epoch = 2").collect()
    mark = F.xxhash64(F.lit(17), "doc_id", "text")
    every = mixing._placed(docs.withColumn("mark", mark), F.lit(2), 17, 1024).collect()
    for source in {r.source for r in got}:
        taken = {r.doc_id for r in got if r.source == source}
        order = sorted((r.block_place, r.place, r.doc_id or -1, tokens(r.text)) for r in every if r.source == source)
        first = [x for *_, x, n in order if n][:len([i for i in taken if i != 3002])]
        assert {x for x in first} == {x if x is not None else -1 for x in taken if x != 3002}


def test_same_result_for_other_partitions(docs):
    one, other = (sorted(mixing.mix(d, keep=["doc_id"]).collect(), key=str) for d in (docs, docs.repartition(2)))
    assert one == other


def test_odd_tables(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert mixing.mix(blank).count() == 2
    long = spark.createDataFrame([(1, "a", "word " * 100_000), (2, "b", "w"), (2, "b", "w")], "doc_id long, source string, text string")
    assert mixing.mix(long, max_repeats=4.0).where("source = 'b'").count() == 8
    with pytest.raises(ValueError, match="mix_epoch"):
        mixing.mix(blank.withColumn("mix_epoch", F.lit(1)))
