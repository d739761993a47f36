"""Levels of the employee tree against a walk in plain Python."""

import random

import pytest

from tillmark.operators import keyed
from tillmark.operators.constraints import RuleBroken
from tillmark.operators.hierarchy import employee_hierarchy


def levels(spark, bosses):
    rows = [(k, f"n{k}", "r", None if b is None else b) for k, b in bosses.items()]
    df = spark.createDataFrame(rows, "employee_id bigint, name string, role string, manager_id bigint")
    return {r["employee_id"]: r["level"] for r in employee_hierarchy(df).collect()}


def walk(bosses):
    found = {}
    for start in bosses:
        steps, at, seen = 1, start, set()
        while at in bosses and at not in seen and bosses[at] is not None:
            seen.add(at)
            at, steps = bosses[at], steps + 1
        if at in bosses and bosses[at] is None:
            found[start] = steps
    return found


def test_chain_deeper_than_a_recursion_limit(spark):
    bosses = {n: (n - 1 if n else None) for n in range(150)}
    assert levels(spark, bosses) == {n: n + 1 for n in range(150)}


def test_cycles_and_missing_managers_are_not_reached(spark):
    bosses = {1: None, 2: 1, 3: 4, 4: 3, 5: 4, 6: 6, 7: 99, 8: 7}
    assert levels(spark, bosses) == {1: 1, 2: 2}


def test_repeated_key_is_an_error(spark):
    """Its pointers would multiply round after round."""
    rows = [(1, "a", "r", None), (1, "b", "r", 2), (2, "c", "r", 1)]
    df = spark.createDataFrame(rows, "employee_id bigint, name string, role string, manager_id bigint")
    with pytest.raises(RuleBroken, match="not unique"):
        employee_hierarchy(df)


def test_no_root(spark):
    assert levels(spark, {1: 2, 2: 1}) == {}


@pytest.mark.parametrize("hot", [False, True])
def test_random_trees(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(keyed, "HOT_MIN_ROWS", 5)
    draw = random.Random(5)
    bosses = {n: draw.choice([0, max(n - 1, 0), draw.randrange(300)]) for n in range(1, 250)}
    bosses[0] = None
    assert levels(spark, bosses) == walk(bosses)
