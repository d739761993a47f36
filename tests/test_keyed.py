"""Joins on one key: small, plain and hot keys must give the same rows, and hot keys must spread."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tillmark.operators import keyed, writes

WAYS = {"small": (100_000, 500, 0), "bitmap": (0, 20, 1 << 26), "plain": (0, 10**9, 0), "hot": (0, 20, 0)}


@pytest.fixture(params=sorted(WAYS))
def way(request, monkeypatch):
    limit, least, bitmap = WAYS[request.param]
    monkeypatch.setattr(keyed, "BITMAP_BYTES", bitmap)
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(keyed, "HOT_MIN_ROWS", least)
    return request.param


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the facts has key 1, a third has no key, the rest is spread; keys 0..29 are unknown."""
    draw = random.Random(3)
    facts = [(n, draw.choice([1, None, draw.randrange(200)])) for n in range(3000)]
    dims = [(k, f"name {k}") for k in [1, *range(30, 400)]]
    fact = spark.createDataFrame(facts, "fact_id bigint, k bigint").repartition(8)
    return facts, dict(dims), fact, spark.createDataFrame(dims, "key bigint, name string")


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_lookup_join(way, sides):
    facts, names, fact, dim = sides
    hits = [f for f in facts if f[1] in names]
    misses = [f for f in facts if f[1] not in names]
    join = lambda how: bag(keyed.lookup_join(fact, dim, "k", "key", how, ["fact_id"]))
    matched = collections.Counter((n, k, k, names[k]) for n, k in hits)
    assert join("inner") == matched
    assert join("left") == matched + collections.Counter((n, k, None, None) for n, k in misses)
    assert join("left_semi") == collections.Counter(hits)
    assert join("left_anti") == collections.Counter(misses)


def test_keeping_the_unique_side(way, sides):
    facts, names, fact, dim = sides
    matched = collections.Counter((n, k, k, names[k]) for n, k in facts if k in names)
    alone = collections.Counter((None, None, k, v) for k, v in names.items() if k not in {k for _, k in facts})
    assert sum(alone.values()) > 100
    misses = collections.Counter((n, k, None, None) for n, k in facts if k not in names)
    join = lambda keep: bag(keyed.lookup_join_keeping(fact, dim, "k", "key", keep, ["fact_id"]))
    assert join(False) == matched + alone
    assert join(True) == matched + alone + misses


def test_keys_present(way, sides):
    facts, names, fact, dim = sides
    used = {k for _, k in facts if k is not None}
    assert {r[0] for r in keyed.keys_present(dim, "key", fact, "k").collect()} == used & set(names)


def test_hot_keys_spread(spark, sides, monkeypatch):
    """Without salts one task holds a third of the rows; with them no task holds a quarter."""
    _, _, fact, dim = sides
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        shares = {}
        for least in (20, 10**9):
            monkeypatch.setattr(keyed, "HOT_MIN_ROWS", least)
            joined = keyed.lookup_join(fact, dim, "k", "key", "left", ["fact_id"])
            sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            shares[least] = max(sizes) / sum(sizes)
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shares[10**9] > 0.3 and shares[20] < 0.25


def test_hot_key_table_is_small_and_complete(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HOT_MIN_ROWS", 20)
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = keyed.hot_keys(df, "k").collect()
    assert [r[0] for r in hot] == [-1] and hot[0][1] >= 2
    assert keyed.hot_keys(spark.range(10_000).withColumnRenamed("id", "k"), "k") is None


def test_hot_line_follows_the_number_of_tasks(spark):
    """A key with a thousandth of the rows is hot once it is more than three average tasks."""
    df = spark.range(800_000).select(F.when(F.col("id") % 1000 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert keyed.hot_keys(df, "k") is None  # hardly a hundredth of the eight tasks
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        hot = keyed.hot_keys(df, "k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r[0] for r in hot] == [-1]
    assert 800 / hot[0][1] <= 3 * 800_000 / 5000


def test_size_check_weighs_text(spark, monkeypatch):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert keyed.fits_broadcast(wide)
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 50_000)
    assert not keyed.fits_broadcast(wide)
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 99)
    assert not keyed.fits_broadcast(spark.range(100))


def test_shared_names_are_refused(spark):
    with pytest.raises(ValueError):
        keyed.lookup_join(spark.range(1), spark.range(1), "id", "id")


def test_bitmap_holds_exactly_its_keys(spark):
    draw = random.Random(9)
    edges = [0, 1, 63, 64, 4095, 4096, -1, -64, -65, -4096, -4097, 2**62, -(2**63), 2**63 - 1]
    keys = [k for k in edges if draw.random() < 0.5] + [draw.randrange(-9000, 9000) for _ in range(3000)] + [None, 5, 5]
    asked = [*edges, None, *range(-9500, 9500)]
    bitmap = keyed.key_bitmap(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k")
    fact = spark.createDataFrame([(a,) for a in asked], "a bigint")
    held = set(keys) - {None}
    for how, wanted in (("left_semi", [a for a in asked if a in held]), ("left_anti", [a for a in asked if a not in held])):
        found = keyed.lookup_join(fact, bitmap.select(F.col(bitmap.columns[0]).alias("k")), "a", "k", how, small=False, bitmap=bitmap)
        assert bag(found) == collections.Counter((a,) for a in wanted)
    assert keyed.key_bitmap(spark.createDataFrame([("x",)], "k string"), "k") is None
    assert keyed.key_bitmap(spark.range(0), "id").isEmpty()


def test_a_large_dense_key_set_reaches_the_scan(spark, monkeypatch):
    """300,000 keys: no exchange of the large side; keys too thinly spread take the shuffle join."""
    fact = spark.range(0, 1_000_000, 1, 8).select(F.col("id").alias("n"), (F.col("id") % 600_000).alias("k"))
    keys = spark.range(0, 600_000, 2, 4).toDF("key")
    for how, rows in (("left_semi", 500_000), ("left_anti", 500_000)):
        found = keyed.lookup_join(fact, keys, "k", "key", how)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert found.count() == rows
    monkeypatch.setattr(keyed, "BITMAP_BYTES", 600 * 100)
    assert keyed.key_bitmap(keys, "key") is None
    assert keyed.lookup_join(fact, keys, "k", "key", "left_semi", hot=None).count() == 500_000


def test_cascade_over_many_keys_does_not_shuffle_the_items(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 100)
    orders = spark.range(0, 20_000, 1, 4).select(F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"))
    items = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("order_item_id"), (F.col("id") % 20_000).alias("order_id"))
    doomed = orders.filter("order_id % 3 = 0").select("order_id")
    states = writes.cascade_delete({"orders": orders, "order_items": items}, {"orders": doomed})
    plan = states["order_items"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert bag(states["order_items"]) == collections.Counter((n, n % 20_000) for n in range(60_000) if n % 20_000 % 3)
    assert states["orders"].count() == 13_333
