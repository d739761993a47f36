"""Rules with NULLs, batches, conflicts and cascades against plain Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.seed import shop
from tillmark.operators import constraints, guards, keyed, relational, writes
from tillmark.operators.constraints import RuleBroken
from tillmark.schema import TABLES, Reference


@pytest.fixture(scope="module")
def t(spark):
    return shop(spark)


@pytest.fixture(params=["small", "bitmap", "hot"])
def way(request, monkeypatch):
    if request.param != "small":
        monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(keyed, "HOT_MIN_ROWS", 3)
    if request.param == "hot":
        monkeypatch.setattr(keyed, "BITMAP_BYTES", 0)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, TABLES[name].columns)


def test_null_passes_checks_but_not_required(spark):
    table = TABLES["customers"]
    df = frame(spark, "customers", [
        (1, "A", "a@b.c", "1", "X"), (2, None, "a@b", None, "X"), (3, "C", None, "1" * 16, "Y"), (4, "D", "@.", "é" * 15, "Z")])
    tagged = constraints.tag_rows(df, constraints.row_rules(table))
    found = {r["customer_id"]: set(r["violations"]) for r in tagged.collect()}
    assert found == {1: set(), 2: {"required name", "required phone", "check email LIKE '%@%.%'"},
                     3: {"required email", "length phone"}, 4: set()}


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    as_key = {tuple(r) for r in constraints.repeated_keys(df, ["k"], nulls_allowed=False).collect()}
    assert as_key == {(1, 2), (None, 2)}
    assert {tuple(r) for r in constraints.repeated_keys(df, ["k"], nulls_allowed=True).collect()} == {(1, 2)}


def test_broken_references(spark, t):
    staff = frame(spark, "employees", [(1, "A", "R", 1, None, None), (2, "B", "R", 99, None, 7), (3, "C", "R", None, None, 2)])
    store, boss = TABLES["employees"].references
    assert [tuple(r) for r in constraints.broken_references(staff, store, t["stores"]).collect()] == [(99, 1)]
    assert [tuple(r) for r in constraints.broken_references(staff, boss, staff).collect()] == [(7, 1)]


def test_swapped_reference_replaces():
    table = TABLES["order_items"].with_reference(Reference("order_id", "archive", "order_id"))
    assert [r.parent for r in table.references] == ["products", "archive"]
    assert len(TABLES["order_items"].references) == 2


def test_seed_is_valid(t):
    for name in ("stores", "employees", "customers", "suppliers", "products", "orders", "order_items"):
        assert constraints.violations(t[name], TABLES[name], t).isEmpty(), name


def test_append_fails_as_a_whole_or_in_part(spark, t, way):
    news = spark.createDataFrame(
        [("N", "n@x.y", "900", "T"), ("M", "c1@example.com", "901", "T"), ("O", "n@x.y", "902", "T"), (None, "p@x.y", "903", "T")],
        "name string, email string, phone string, city string")
    with pytest.raises(RuleBroken, match="required name: 1, unique email: 2"):
        writes.append_rows(t["customers"], news, TABLES["customers"], order_by=["phone"])
    change = writes.append_rows(t["customers"], news, TABLES["customers"], mode="quarantine", order_by=["phone"])
    assert [tuple(r) for r in change.rows.collect()] == [(21, "N", "n@x.y", "900", "T")]
    assert {(r["phone"], tuple(r["violations"])) for r in change.refused.collect()} == {
        ("901", ("unique email",)), ("902", ("unique email",)), ("903", ("required name",))}
    assert change.state.count() == 21


def test_append_defaults(spark, t):
    day = dt.datetime(2025, 5, 5)
    news = spark.createDataFrame([(1, 1, Decimal("5.00"))], "customer_id bigint, store_id bigint, total_amount decimal(10,2)")
    row = writes.append_rows(t["orders"], news, TABLES["orders"], t, as_of=day).rows.first()
    assert (row["order_id"], row["order_date"]) == (101, day)
    given = news.withColumn("order_date", F.lit(None).cast("timestamp_ntz"))
    assert writes.append_rows(t["orders"], given, TABLES["orders"], t, as_of=day).rows.first()["order_date"] is None


def test_append_dates_by_the_clock(spark, t):
    news = spark.createDataFrame([(1, 1, Decimal("5.00"))], "customer_id bigint, store_id bigint, total_amount decimal(10,2)")
    day = writes.append_rows(t["orders"], news, TABLES["orders"], t).rows.first()["order_date"]
    assert abs(day - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=10)


def test_append_items_guard_and_rules(spark, t, way):
    rows = [(None, 1, 4, 21, Decimal(1)), (None, 1, 4, 20, Decimal(1)), (None, 1, 99, 5, Decimal(1)), (None, 999, 1, 5, Decimal(1)),
            (None, 1, 1, 0, Decimal(1)), (None, None, None, None, None)]
    news = frame(spark, "order_items", rows).drop("order_item_id")
    with pytest.raises(RuleBroken, match="stock"):
        writes.append_order_items(t["order_items"], news, t["products"], t["orders"])
    change = writes.append_order_items(t["order_items"], news, t["products"], t["orders"], mode="quarantine",
                                       order_by=["order_id", "product_id", "quantity"])
    assert {(r["product_id"], r["quantity"]) for r in change.rows.collect()} == {(4, 20), (None, None)}
    assert {r["violations"][0] for r in change.refused.collect()} == {
        "out of stock", "reference product_id", "reference order_id", "check quantity > 0"}
    assert change.rows.count() + change.refused.count() == len(rows)


def test_assign_keys_is_dense_and_ordered(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    numbered = writes.assign_keys(df, "n", ["v"], after=10).collect()
    assert sorted(r["n"] for r in numbered) == list(range(11, 5011))
    values = [r["v"] for r in sorted(numbered, key=lambda r: r["n"])]
    assert values == sorted(values)


def _row_after_row(stored, batch, columns):
    """What one insert after the other would do."""
    seen = {c: {row[c] for row in stored if row[c] is not None} for c in columns}
    kept = []
    for row in batch:
        if all(row[c] is None or row[c] not in seen[c] for c in columns):
            kept.append(row)
            for c in columns:
                seen[c].add(row[c])
    return kept


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("columns", [("a",), ("a", "b", "c")])
def test_insert_ignore_is_row_after_row(spark, way, seed, columns):
    draw = random.Random(seed)
    make = lambda n: [
        {"id": i, **{c: draw.choice([None, draw.randrange(60), 1]) for c in "abc"}} for i in range(n)]
    schema = "id bigint, a bigint, b bigint, c bigint"
    stored, batch = make(5), make(150)
    table, news = spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema)
    change = writes.insert_ignore(table, news, columns, ["id"])
    expected = sorted(row["id"] for row in _row_after_row(stored, batch, columns))
    assert sorted(r["id"] for r in change.rows.collect()) == expected
    assert change.state.count() == 5 + len(expected)


def _counted_steps(monkeypatch):
    """Labels of the steps that ``settle`` writes."""
    labels, plain = [], writes.written
    monkeypatch.setattr(writes, "written", lambda df, label: labels.append(label) or plain(df, label))
    return labels


def test_a_long_chain_is_settled_by_doubled_pointers(spark, monkeypatch):
    """Each row clashes with the one before, on two columns in turn: every other row goes in."""
    chain = [{"id": i, "a": i // 2, "b": (i + 1) // 2} for i in range(4000)]
    other = [{"id": 5000 + i, "a": 9000 + i % 3, "b": None} for i in range(10)]
    schema = "id bigint, a bigint, b bigint"
    labels = _counted_steps(monkeypatch)
    change = writes.insert_ignore(spark.createDataFrame([], schema), spark.createDataFrame(chain + other, schema), ["a", "b"], ["id"])
    expected = [row["id"] for row in _row_after_row([], chain + other, ["a", "b"])]
    assert sorted(r["id"] for r in change.rows.collect()) == sorted(expected)
    assert labels.count("standing") + labels.count("chains") < 15


@pytest.mark.parametrize("seed", range(4))
def test_tangled_rows_are_settled_as_row_after_row(spark, seed):
    """Short and long chains, values that hold many rows, and rows that hang on several others."""
    draw = random.Random(seed)
    spread = [3, 12, 40, 90][seed]
    batch = [{"id": i, "a": draw.choice([None, i // 2, draw.randrange(spread)]), "b": draw.choice([i // 3, (i + 1) // 2, 1]),
              "c": draw.choice([None, None, draw.randrange(spread)])} for i in range(120)]
    schema = "id bigint, a bigint, b bigint, c bigint"
    change = writes.insert_ignore(spark.createDataFrame([], schema), spark.createDataFrame(batch, schema), ["a", "b", "c"], ["id"])
    expected = [row["id"] for row in _row_after_row([], batch, ["a", "b", "c"])]
    assert sorted(r["id"] for r in change.rows.collect()) == sorted(expected)


def test_rows_of_a_common_value_are_not_gathered(spark):
    """A value that most rows share gives each task two rows at most to the shuffle, and no step grows with its square."""
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).cast("bigint").alias("a"),
                                      (F.col("id") % 5_000).alias("b"))
    change = writes.insert_ignore(rows.limit(0), rows, ["a", "b"], ["id"])
    plain = [{"id": i, "a": 7 if i % 10 < 9 else i, "b": i % 5_000} for i in range(20_000)]
    assert change.rows.count() == len(_row_after_row([], plain, ["a", "b"]))
    ranked = writes._openers(constraints.written(rows.select(F.col("id").alias("turn"), F.col("a").cast("string").alias("entry")), "x"))
    assert ranked.filter("_shared = '7'").collect()[0][1:] == (0, 1)


@pytest.mark.parametrize("line", [100_000, 0])
def test_all_keys_and_references_in_one_probe(spark, line, monkeypatch):
    """Rows that break several rules at once; few or many breaking values (sent to the rows, or joined once)."""
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", line)
    schema = TABLES["orders"].columns
    parents = {"customers": frame(spark, "customers", [(1, "A", "a@b.c", "1", "X")]), "stores": frame(spark, "stores", [(1, "S", "L", None)])}
    day = dt.datetime(2024, 1, 1)
    stored = spark.createDataFrame([(10, 1, 1, day, Decimal(1))], schema)
    news = [(10, 1, 1), (11, 1, 1), (11, 9, 1), (12, 9, 9), (None, 9, None), (13, None, None), (14, 1, 9)]
    batch = spark.createDataFrame([(*r, day, Decimal(1)) for r in news], schema)
    change = writes.append_rows(stored, batch, TABLES["orders"], parents, "quarantine", ["customer_id"])
    assert sorted(r["order_id"] for r in change.rows.collect()) == [11, 13]
    assert sorted(((r["order_id"], tuple(r["violations"])) for r in change.refused.collect()), key=str) == sorted([
        (10, ("primary key",)), (11, ("primary key", "reference customer_id")), (12, ("reference customer_id", "reference store_id")),
        (None, ("primary key", "reference customer_id")), (14, ("reference store_id",))], key=str)


def test_insert_unless_taken_keeps_the_other_rules(spark, t, way):
    table = TABLES["suppliers"]
    rows = [(3, "S", "C", "0000000001", "T"), (3, "S", "C", "new 1", "T"), (30, "S", None, "new 2", "T"), (31, "S", "C", "9" * 16, "T"),
            (32, "S", "C", "new 3", "T"), (33, "S", "C", "new 3", "T")]
    news = frame(spark, "suppliers", rows)
    change = writes.insert_unless_taken(t["suppliers"], news, table, "phone", ["supplier_id"], mode="quarantine")
    assert [r["supplier_id"] for r in change.rows.collect()] == [32]
    assert {(r["supplier_id"], tuple(r["violations"])) for r in change.refused.collect()} == {
        (3, ("primary key",)), (30, ("required contact_person",)), (31, ("length phone",))}
    with pytest.raises(RuleBroken, match="length phone: 1"):
        writes.insert_unless_taken(t["suppliers"], news, table, "phone", ["supplier_id"])
    with pytest.raises(RuleBroken, match="primary key: 1"):
        writes.insert_unless_taken(t["suppliers"], news.limit(2), table, "phone", ["supplier_id"])


def test_conflict_column_must_be_unique(spark, t):
    with pytest.raises(ValueError, match="not unique"):
        writes.insert_unless_taken(t["employees"], t["employees"], TABLES["employees"], "name")
    news = spark.createDataFrame([("Shop 1", "Elsewhere"), ("Shop 9", "Here"), ("Shop 9", "There")], "name string, location string")
    change = writes.insert_unless_taken(t["stores"], news, TABLES["stores"], "name", ["location"])
    assert [tuple(r) for r in change.rows.collect()] == [(6, "Shop 9", "Here", None)]


def test_import_by_position(spark, t, way):
    texts = spark.createDataFrame(
        [("1", "A", "a@x.y", "77", "T"), ("30", "B", "b@x.y", "78", "T"), ("31", "C", "b@x.y", "79", "T")],
        ", ".join(f"c{n} string" for n in range(1, 6)))
    change = writes.import_ignore(t["customers"], texts, TABLES["customers"], order_by=["customer_id"])
    assert [r["customer_id"] for r in change.rows.collect()] == [30]
    bad = texts.withColumn("c3", F.lit("nobody"))
    with pytest.raises(RuleBroken, match="check email"):
        writes.import_ignore(t["customers"], bad, TABLES["customers"])
    with pytest.raises(ValueError, match="5 columns"):
        writes.import_ignore(t["customers"], texts.drop("c5"), TABLES["customers"])
    odd = spark.createDataFrame([(None, "A", "k@x.y", "80", "T"), ("4x", "A", "l@x.y", "81", "T"), ("40", "A", "m@x.y", "82", "T")], texts.schema)
    kept = writes.import_ignore(t["customers"], odd, TABLES["customers"], mode="quarantine")
    assert [r["customer_id"] for r in kept.rows.collect()] == [40]
    assert {(r["phone"], tuple(r["violations"])) for r in kept.refused.collect()} == {
        ("80", ("primary key",)), ("81", ("type customer_id", "primary key"))}
    with pytest.raises(RuleBroken, match="primary key: 1"):
        writes.import_ignore(t["customers"], odd.filter("c1 IS NULL OR c1 = '40'"), TABLES["customers"])
    orders = spark.createDataFrame(
        [("500", "1", "1", "2025-01-01 00:00:00", "5"), ("501", "77", "1", "2025-01-01 00:00:00", "5")],
        "a string, b string, c string, d string, e string")
    with pytest.raises(RuleBroken, match="reference customer_id: 1"):
        writes.import_ignore(t["orders"], orders, TABLES["orders"], t)
    kept = writes.import_ignore(t["orders"], orders, TABLES["orders"], t, mode="quarantine")
    assert [r["order_id"] for r in kept.rows.collect()] == [500] and kept.refused.count() == 1


def test_text_rows(spark):
    table = TABLES["products"]
    texts = spark.createDataFrame([(" 7 ", "NULL", "c", "1.5", "null", "x")], ",".join(f"{c} string" for c in table.columns.names))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        writes.typed_rows(texts, table).collect()
    assert tuple(writes.typed_rows(texts, table, strict=False).first()) == (7, None, "c", Decimal("1.50"), None, None)


def test_insert_text_rows(spark, t):
    names = ",".join(f"{c} string" for c in TABLES["products"].columns.names)
    texts = spark.createDataFrame(
        [(" 50 ", "Mug", "Kitchen", "1.5", "null", "1"), ("51", "Mug", "Kitchen", "x", "1", "1"), ("52", "Null", "Kitchen", "1", "1", "1"),
         ("53", "Mug", "Kitchen", "1", "1", "99"), ("4", "Mug", "Kitchen", "1", "1", "1")], names)
    change = writes.insert_text_rows(t["products"], texts, TABLES["products"], t, mode="quarantine")
    assert [tuple(r) for r in change.rows.collect()] == [(50, "Mug", "Kitchen", Decimal("1.50"), None, 1)]
    assert {(r["product_id"], tuple(r["violations"])) for r in change.refused.collect()} == {
        (51, ("type price",)), (52, ("required name",)), (53, ("reference supplier_id",)), (4, ("primary key",))}
    assert change.state.count() == 17
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        writes.insert_text_rows(t["products"], texts, TABLES["products"], t)


def test_guard_lets_unknown_pass(spark, way):
    goods = frame(spark, "products", [(1, "a", "c", None, 5, None), (2, "b", "c", None, None, None)])
    items = frame(spark, "order_items", [(1, 1, 1, 5, None), (2, 1, 1, 6, None), (3, 1, 2, 9, None), (4, 1, 3, 9, None), (5, 1, 1, None, None)])
    accepted, rejected = guards.guard_stock(items, goods, mode="quarantine")
    assert {r["order_item_id"] for r in accepted.collect()} == {1, 3, 4, 5}
    assert [(r["order_item_id"], r["stock"]) for r in rejected.collect()] == [(2, 5)]


def test_stock_updates(spark, t):
    news = spark.createDataFrame([(1, 7), (99, 1)], "product_id bigint, new_stock int")
    stock = {r["product_id"]: r["stock"] for r in writes.refresh_stock(t["products"], news).state.collect()}
    assert stock[1] == 7 and stock[2] == 100 and 99 not in stock
    odd = spark.createDataFrame([(1, 7), (1, 7), (2, 5), (2, 6), (3, -7), (4, None), (5, None), (5, 1), (None, 3), (99, -1)], news.schema)
    change = writes.refresh_stock(t["products"], odd, mode="quarantine")
    stock = {r["product_id"]: r["stock"] for r in change.state.collect()}
    assert len(stock) == change.state.count() == 16
    assert [stock[n] for n in range(1, 6)] == [7, 100, 200, None, 100]
    assert {(r["product_id"], *r["violations"]) for r in change.refused.collect()} == {
        (2, "several levels"), (3, "check stock >= 0"), (5, "several levels")}
    for bad in (odd.filter("product_id = 2"), odd.filter("product_id = 3")):
        with pytest.raises(Exception, match="stock refused"):
            writes.refresh_stock(t["products"], bad).state.collect()
    more = spark.createDataFrame([(1, 5), (1, 6), (4, -20)], "product_id bigint, quantity int")
    stock = {r["product_id"]: r["stock"] for r in writes.add_stock(t["products"], more).collect()}
    assert stock[1] == 61 and stock[4] == 0 and stock[2] == 100
    with pytest.raises(Exception, match="stock below 0"):
        writes.add_stock(t["products"], more.withColumn("quantity", F.lit(-500))).collect()


def test_update_customers(spark, t, way):
    good = frame(spark, "customers", [(3, "New", "c4@example.com", "5", "C"), (4, "N4", "n4@x.y", "0000000004", "C"), (77, "X", "x@y.z", "6", "C")])
    change = writes.update_customers(t["customers"], good)
    state = {r["customer_id"]: tuple(r) for r in change.state.collect()}
    assert state[3] == (3, "New", "c4@example.com", "5", "C") and 77 not in state and change.state.count() == 20
    assert constraints.violations(change.state, TABLES["customers"], {}).isEmpty()
    bad = frame(spark, "customers", [
        (1, None, "bad", "1", "C"), (2, "A", "a@x.y", "0000000005", "C"), (6, "A", "d@x.y", "61", "C"), (6, "A", "e@x.y", "62", "C"),
        (7, "A", "same@x.y", "71", "C"), (8, "A", "same@x.y", "81", "C"), (9, "A", "c10@example.com", "91", "C"),
        (10, "A", "ten@x.y", "101", "C"), (11, "A", "c11@example.com", "111", "C")])
    with pytest.raises(RuleBroken, match="required name: 1, unique email: 2, unique phone: 1"):
        writes.update_customers(t["customers"], bad)
    change = writes.update_customers(t["customers"], bad, mode="quarantine")
    assert {r["customer_id"] for r in change.rows.collect()} == {10, 11}
    broken = {r["customer_id"]: set(r["violations"]) for r in change.refused.collect()}
    assert broken[1] >= {"required name", "check email LIKE '%@%.%'"} and broken[2] == {"unique phone"}
    assert broken[6] == {"repeated customer_id"} and broken[7] == broken[8] == broken[9] == {"unique email"}
    assert change.state.count() == 20 and constraints.violations(change.state, TABLES["customers"], {}).isEmpty()


def test_delete_customers(spark, t, way):
    orders = t["orders"].filter("customer_id <> 4")
    keys = spark.createDataFrame([(4,), (5,), (99,)], "customer_id bigint")
    change = writes.delete_customers(t["customers"], orders, keys, mode="quarantine")
    assert {r[0] for r in change.refused.collect()} == {5}
    assert change.state.count() == 19


def test_stale_rule_with_nulls(spark, t):
    day = dt.datetime(2025, 1, 1)
    orders = frame(spark, "orders", [(1, 1, 1, day, None), (2, 2, 1, None, None), (3, 3, 1, day, None),
                                     (4, 3, 1, dt.datetime(2000, 1, 1), None), (5, None, 1, day, None)])
    kept = writes.delete_stale_customers({**t, "orders": orders}, "2025-06-01")
    assert [r[0] for r in kept["customers"].collect()] == [1]
    assert {r[0] for r in kept["orders"].collect()} == {1, 5}
    preview = relational.stale_preview(t["customers"], orders, "2025-06-01")
    assert preview.filter("order_id IS NOT NULL").count() == 2 and preview.count() == 19


def test_cascade_leaves_no_orphan(spark, t, way):
    payments = frame(spark, "payments", [(n, n, Decimal(1), "Cash", None) for n in range(1, 101)])
    doomed = {"stores": spark.createDataFrame([(1,), (2,)], "store_id bigint"),
              "customers": spark.createDataFrame([(5,)], "customer_id bigint"),
              "products": spark.createDataFrame([(4,)], "product_id bigint")}
    states = writes.cascade_delete({**t, "payments": payments}, doomed, "2025-01-01")
    for name, table in TABLES.items():
        for reference in table.references:
            assert constraints.broken_references(states[name], reference, states[reference.parent]).isEmpty(), reference
    assert states["employee_audit"].count() == 4 and states["employees"].count() == 6
    orders = {r["order_id"] for r in t["orders"].collect() if r["store_id"] > 2 and r["customer_id"] != 5}
    assert {r["order_id"] for r in states["orders"].collect()} == orders
    assert states["payments"].count() == len(orders)
    items = {r["order_item_id"] for r in t["order_items"].collect() if r["order_id"] in orders and r["product_id"] != 4}
    assert {r["order_item_id"] for r in states["order_items"].collect()} == items
    assert states["products"].count() == 15 and states["suppliers"].count() == 10
