"""Inserts, updates and deletes: each returns the new state of a table as a DataFrame.

Publishing a state (``tillmark.sinks.tables.publish``) writes it as a new version; nothing is
changed in place. ``as_of`` stands for the time of the statement.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.money import scaled
from tillmark.functions.temporal import Moment, before, moment
from tillmark.functions.text import from_text
from tillmark.operators.constraints import (
    ARRIVAL,
    VIOLATIONS,
    RuleBroken,
    breaches,
    held_values,
    in_order,
    key_rules,
    key_values,
    probes_of,
    refuse_if_any,
    row_rules,
    split_valid,
    stored_values,
    tag_breaches,
    tag_held,
    tag_rows,
    value_turns,
    values_of,
    with_arrival,
)
from tillmark.operators.guards import audit_rows, guard_arrivals
from tillmark.operators.keyed import fits_broadcast, hot_keys, key_bitmap, keys_present, lookup_join, row_count, written
from tillmark.operators.relational import stale_customers
from tillmark.schema import TABLES, Table
from tillmark.session import materialize


class Change(NamedTuple):
    """New state of a table, the rows added or removed, and the rows refused."""

    state: DataFrame
    rows: DataFrame
    refused: DataFrame


# ---- inserts ---------------------------------------------------------------------------


def assign_keys(batch: DataFrame, key: str, order_by: Sequence[str] = (), after: int = 0) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in the stated order, as column ``key``; without
    one in order of arrival, which needs no sort.

    With an order the batch is sorted into ranges over all tasks. It is written with each row's range
    (the task) and place in it; the first number of a range follows from the row counts of the ranges
    before it (one small row per range). No task sees more than its own range. Rows that are alike in
    ``order_by`` are split by place of arrival, which is written down first: a task that runs
    again after a lost executor then sorts by the same values.
    """
    columns = [c for c in batch.columns if c != ARRIVAL]
    if order_by:
        arrived = batch if ARRIVAL in batch.columns else with_arrival(batch)
        batch = arrived.orderBy(*order_by, ARRIVAL)
    placed = batch.select(*columns, F.spark_partition_id().alias("_range"),
                           F.monotonically_increasing_id().alias("_place"))
    # The place counts up from 2^33 times the number of the range.
    placed = materialize(placed.withColumn("_place", F.col("_place") % (1 << 33)), "numbered")
    sizes = {row["_range"]: row["count"] for row in placed.groupBy("_range").count().collect()}
    starts, total = [], after
    for number in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(number, 0)
    # a number per task goes along with the plan, so that reading the numbered rows again needs no join
    start = F.get(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), F.col("_range"))
    return placed.select((start + F.col("_place") + 1).alias(key), *columns)


def fill_defaults(batch: DataFrame, table: Table, as_of: Moment) -> DataFrame:
    """The batch in the table's columns and types; a value that does not fit its type raises.

    A left-out column gets the time of the insert where that is the default, else NULL. A column
    that is there keeps its NULLs.
    """

    def value(name: str) -> Column:
        if name in batch.columns:
            return F.col(name)
        return moment(as_of) if name in table.dated else F.lit(None)

    return batch.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in table.columns.fields])


def prepare(existing: DataFrame, batch: DataFrame, table: Table, order_by: Sequence[str],
            as_of: Moment) -> DataFrame:
    """The batch with keys (when left out) and defaults."""
    if table.key not in batch.columns:
        last = existing.agg(F.max(table.key)).first()[0] or 0
        batch = assign_keys(batch, table.key, order_by, after=last)
    return fill_defaults(batch, table, as_of)


def append_rows(existing: DataFrame, batch: DataFrame, table: Table,
                parents: Mapping[str, DataFrame] | None = None, mode: str = "fail",
                order_by: Sequence[str] = (), as_of: Moment = None) -> Change:
    """Insert a batch. In mode ``fail`` one bad row refuses the whole batch; ``quarantine``
    inserts the good rows and returns the others."""
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    ready = prepare(existing, batch, table, order_by, as_of)
    numbered = table.key not in batch.columns
    accepted, rejected = split_valid(ready, table, parents, existing, order_by, numbered)
    if mode == "fail":
        refuse_if_any(rejected, f"insert into {table.name} refused")
    state = existing.unionByName(accepted, allowMissingColumns=True)
    return Change(state, accepted, rejected)


def append_order_items(existing: DataFrame, batch: DataFrame, products: DataFrame, orders: DataFrame,
                       mode: str = "fail", order_by: Sequence[str] = ()) -> Change:
    """Insert order items behind the stock guard."""
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    accepted, short = guard_arrivals(batch, products)
    if mode == "fail" and not short.isEmpty():
        raise RuleBroken("cannot place order: out of stock")
    if TABLES["order_items"].key in batch.columns:
        accepted = accepted.drop(ARRIVAL)
    parents = {"products": products, "orders": orders}
    change = append_rows(existing, accepted, TABLES["order_items"], parents, mode, order_by)
    return Change(change.state, change.rows, change.refused.unionByName(
        short.drop("stock").withColumn("violations", F.array(F.lit("out of stock"))), allowMissingColumns=True))


def insert_ignore(existing: DataFrame, batch: DataFrame, unique: Sequence[str],
                  order_by: Sequence[str] = ()) -> Change:
    """Insert the rows that collide on no ``unique`` column with a stored row or with an earlier
    inserted row of the batch, as if row after row; NULLs never collide.

    Rows that hold a stored value go first. Of the others, rows whose values occur once go in at once. With one
    column the first row of each value goes in; with several a row may be first for one value and not for
    another, and a skipped row does not block later ones: see ``settle``.
    """
    columns = batch.columns
    waiting = in_order(batch, order_by)
    turns = value_turns(waiting, unique)
    stored = stored_values(existing, unique, turns)
    if row_count(stored):
        small, arrived = fits_broadcast(stored), waiting
        for key in unique:
            hot = None if small else hot_keys(arrived, key)
            waiting = lookup_join(waiting, values_of(stored, key, batch), key, "_clash", "left_anti", columns, small, hot)
        waiting = written(waiting, "free")
        turns = value_turns(waiting, unique)
    repeated = written(turns.filter(F.col("_rows") > 1).select("_column", "_value", "_first"), "repeated")
    if not row_count(repeated):
        inserted = waiting.select(*columns)
    elif len(unique) == 1:
        key = unique[0]
        leaders = values_of(repeated, key, batch)
        led = lookup_join(waiting, leaders, key, "_clash", "left", columns, fits_broadcast(repeated))
        inserted = led.filter(F.col("_first").isNull() | (F.col("_first") == F.col("_turn"))).select(*columns)
    else:
        skipped = settle(_clashing_entries(waiting, unique, repeated))
        inserted = lookup_join(waiting, skipped, "_turn", "_skipped", "left_anti", hot=None).select(*columns)
    return Change(existing.unionByName(inserted, allowMissingColumns=True), inserted, inserted.limit(0))


def _clashing_entries(waiting: DataFrame, unique: Sequence[str], repeated: DataFrame) -> DataFrame:
    """(turn, entry) of each row and each of its values that other rows hold too, a written table."""
    entry = F.concat_ws(":", "_column", "_value")
    values = repeated.select(entry.alias("_shared"))
    entries = key_values(waiting, unique, F.col("_turn").alias("turn")).select("turn", entry.alias("entry"))
    return written(lookup_join(entries, values, "entry", "_shared", "left_semi", ["turn"], fits_broadcast(repeated)), "entries")


def _openers(entries: DataFrame) -> DataFrame:
    """Per entry its first row (``first``) and the second (``second``, NULL if there is none), a written table.

    Rows are ranked within each task before the shuffle too, so at most two rows per entry and task travel.
    """
    rank = F.row_number().over(Window.partitionBy("entry").orderBy("turn")).alias("rank")
    two = entries.select("turn", "entry", rank).filter("rank <= 2")
    first, second = (F.min(F.when(F.col("rank") == n, F.col("turn"))) for n in (1, 2))
    return written(two.groupBy(F.col("entry").alias("_shared")).agg(first.alias("first"), second.alias("second")), "openers")


def _standing(entries: DataFrame) -> DataFrame:
    """Per row ``node``: ``many`` (several earlier rows share a value with it), or else the one that does as ``up``,
    NULL if there is none; a written table."""
    openers = _openers(entries)
    placed = lookup_join(entries, openers, "entry", "_shared", "inner", ["turn"])
    leads, follows = F.col("turn") == F.col("first"), F.col("turn") == F.coalesce("second", "first")
    before = F.when(~leads, F.col("first"))  # the one row before, if it is the only one
    return written(placed.groupBy(F.col("turn").alias("node")).agg(
        F.max(~leads & ~follows).alias("crowd"), F.min(before).alias("up"), F.max(before).alias("other")
    ).select("node", "up", (F.col("crowd") | F.coalesce(F.col("up") != F.col("other"), F.lit(False))).alias("many")), "standing")


def settle(entries: DataFrame) -> DataFrame:
    """Rows that do not go in (``_skipped``) when rows go in turn after turn, unless an earlier one that went in
    shares an entry; ``entries`` (turn, entry) is a written table.

    Nothing is gathered into one group. In every round, a row that no earlier row shares an entry with goes in. A row
    with one such earlier row goes in exactly if that one does not, so along such rows the outcome alternates:
    each points to the one before, and pointers are doubled until they reach a row that goes in, which settles it by
    the parity of the distance, or a row with several earlier ones, which waits. Then all who share an entry with
    those that went in are skipped, and the rows left play again. A chain of n rows takes log2(n) steps of one
    round; rounds are needed only where rows hang on several others, and every round settles a row at least.
    """
    skipped = None
    while True:
        standing = _standing(entries)
        open_ends = standing.filter("NOT many AND up IS NOT NULL")
        goes_in = standing.filter("NOT many AND up IS NULL").select("node")
        reached = _ends(standing, open_ends)
        if reached is not None:
            goes_in = goes_in.unionByName(reached.filter("NOT odd").select("node"))
        goes_in = written(goes_in, "goes_in")
        small = fits_broadcast(goes_in)
        own = lookup_join(entries, goes_in, "turn", "node", "left_semi", small=small, hot=None)
        taken = written(own.select(F.col("entry").alias("_taken")).distinct(), "taken")
        rest = lookup_join(entries, goes_in, "turn", "node", "left_anti", small=small, hot=None)
        blocked = lookup_join(rest, taken, "entry", "_taken", "left_semi", ["turn"])
        blocked = written(blocked.select(F.col("turn").alias("_skipped")).distinct(), "blocked")
        skipped = blocked if skipped is None else skipped.unionByName(blocked)
        entries = written(lookup_join(rest, blocked, "turn", "_skipped", "left_anti", hot=None), "entries")
        if not row_count(entries):
            return written(skipped, "skipped")


def _ends(standing: DataFrame, chained: DataFrame) -> DataFrame | None:
    """(node, odd) of the rows whose chain of single earlier rows begins at one that goes in; ``odd`` is the parity
    of its length. None where there is no chain."""
    ends = standing.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("many").alias("_many"))
    step = lookup_join(chained, ends, "up", "_node", "inner", ["node"])
    # ``to`` is the row reached, ``open`` says that it hangs on one row itself, ``roots`` that it goes in
    state = written(step.select("node", F.col("up").alias("to"), F.lit(True).alias("odd"),
                                (~F.col("_many") & F.col("_up").isNotNull()).alias("open"),
                                (~F.col("_many") & F.col("_up").isNull()).alias("roots")), "chains")
    if not row_count(state):
        return None
    done = state.filter("NOT open")
    moving = written(state.filter("open"), "moving")
    while row_count(moving):
        targets = done.unionByName(moving).select(*[F.col(c).alias(f"_{c}") for c in ("node", "to", "odd", "open", "roots")])
        moved = written(lookup_join(moving, targets, "to", "_node", "inner", ["node"]).select(
            "node", F.col("_to").alias("to"), (F.col("odd") != F.col("_odd")).alias("odd"), F.col("_open").alias("open"),
            F.col("_roots").alias("roots")), "chains")
        done = done.unionByName(moved.filter("NOT open"))
        moving = written(moved.filter("open"), "moving")
    return done.filter("roots")


def insert_unless_taken(existing: DataFrame, batch: DataFrame, table: Table, conflict: str,
                        order_by: Sequence[str] = (), as_of: Moment = None, mode: str = "fail",
                        parents: Mapping[str, DataFrame] | None = None) -> Change:
    """Insert rows, skipping those that collide on one named unique column.

    Skipping on a column that is not unique in the table is an error, as it is in SQL. All other rules of
    the table hold: rows are tested for their own rules first, and the rows that are to go in for the other
    keys and the references. In mode ``fail`` one such breach refuses the whole batch, ``quarantine``
    refuses the rows that break a rule.
    """
    if conflict not in (table.key, *table.unique):
        raise ValueError(f"{table.name}.{conflict} is not unique")
    numbered = table.key not in batch.columns
    tagged = tag_rows(fill_defaults(batch, table, as_of), row_rules(table))
    unsound = tagged.filter(F.size(VIOLATIONS) > 0)
    if mode == "fail":
        refuse_if_any(unsound, f"insert into {table.name} refused")
    sound = tagged.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    rows = insert_ignore(existing, sound.drop(table.key) if numbered else sound, [conflict], order_by).rows
    ready = prepare(existing, rows, table, order_by, as_of)
    accepted, rejected = split_valid(ready, table, parents, existing, order_by, numbered, [conflict])
    if mode == "fail":
        refuse_if_any(rejected, f"insert into {table.name} refused")
    return Change(existing.unionByName(accepted), accepted, unsound.unionByName(rejected))


def _typed(texts: DataFrame, table: Table, values: Sequence[Column], strict: bool, keep: Sequence[str] = ()) -> DataFrame:
    """Text values as the columns of a table, and the columns ``keep`` as they are. A value that does not fit its
    type raises or, when ``strict`` is off, is NULL and named in ``_types``."""
    fields = table.columns.fields
    if strict:
        cast = [v.cast(f.dataType).alias(f.name) for v, f in zip(values, fields)]
        return texts.select(*cast, *keep, F.array().cast("array<string>").alias("_types"))
    tried = [v.try_cast(f.dataType) for v, f in zip(values, fields)]
    unfit = [F.when(v.isNotNull() & t.isNull(), F.lit(f"type {f.name}")) for v, t, f in zip(values, tried, fields)]
    return texts.select(*[t.alias(f.name) for t, f in zip(tried, fields)], *keep,
                        F.array_compact(F.array(*unfit)).alias("_types"))


def by_position(texts: DataFrame, table: Table, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns as the columns of a table, matched by position and cast to their types, with
    the misfits in ``_types``; the columns ``keep`` are no part of it and stay."""
    names = [name for name in texts.columns if name not in keep]
    if len(names) != len(table.columns.fields):
        raise ValueError(f"{table.name} has {len(table.columns.fields)} columns, the input {len(names)}")
    return _typed(texts, table, [F.col(f"`{name}`") for name in names], strict, keep)


def import_ignore(existing: DataFrame, texts: DataFrame, table: Table,
                  parents: Mapping[str, DataFrame] | None = None, mode: str = "fail",
                  order_by: Sequence[str] = (), place: str | None = None) -> Change:
    """Insert file rows by position, skipping rows that collide on any unique column.

    Rows go in by ``order_by``, then by ``place``, the column with a row's place in its file (see ``scan_csv_text``);
    without one in order of arrival. Only collisions are skipped. A row with a malformed value, without a key or against a rule of its own, or
    an inserted row that breaks a reference, refuses the whole file in mode ``fail`` and only itself in
    ``quarantine``.
    """
    held = [place] if place else []
    order_by = [*order_by, *held]
    typed = by_position(texts, table, strict=mode == "fail", keep=held)
    tagged = tag_rows(typed, [("primary key", F.col(table.key).isNull()), *row_rules(table)])
    tagged = tagged.withColumn(VIOLATIONS, F.concat("_types", VIOLATIONS)).drop("_types")
    refused = tagged.filter(F.size(VIOLATIONS) > 0).drop(*held)
    if mode == "fail":
        refuse_if_any(refused, f"import into {table.name} refused")
    sound = tagged.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    rows = insert_ignore(existing, sound, [key for _, key in key_rules(table)], order_by).rows
    if not parents:
        rows = rows.drop(*held)
        return Change(existing.unionByName(rows, allowMissingColumns=True), rows, refused)
    probes = probes_of(table, parents, [key for _, key in key_rules(table)])
    arrived = in_order(rows, order_by).drop(*held)
    referring = tag_breaches(tag_rows(arrived, []), breaches(arrived, probes, None), probes, table.key).drop("_turn")
    orphans = referring.filter(F.size(VIOLATIONS) > 0)
    if mode == "fail":
        refuse_if_any(orphans, f"import into {table.name} refused")
    rows = referring.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    return Change(existing.unionByName(rows, allowMissingColumns=True), rows, refused.unionByName(orphans))


def typed_rows(texts: DataFrame, table: Table, strict: bool = True) -> DataFrame:
    """Rows of text, one per column of the table, as typed rows; the word null is NULL."""
    return texts.select(*[
        from_text(F.col(f.name), f.dataType, strict).alias(f.name) for f in table.columns.fields
    ])


def insert_text_rows(existing: DataFrame, texts: DataFrame, table: Table,
                     parents: Mapping[str, DataFrame] | None = None, mode: str = "fail",
                     order_by: Sequence[str] = ()) -> Change:
    """Insert rows of text, one column per column of the table, under the table's rules; the word null
    is NULL. A malformed value raises in mode ``fail`` and refuses its row in ``quarantine``."""
    values = [from_text(F.col(f.name), T.StringType()) for f in table.columns.fields]
    typed = _typed(texts, table, values, strict=mode == "fail")
    misfits = typed.filter(F.size("_types") > 0).withColumnRenamed("_types", VIOLATIONS)
    fitting = typed.filter(F.size("_types") == 0).drop("_types")
    change = append_rows(existing, fitting, table, parents, mode, order_by)
    return Change(change.state, change.rows, change.refused.unionByName(misfits))


# ---- updates ---------------------------------------------------------------------------


def update_where(df: DataFrame, condition: Column, column: str, value: Column) -> DataFrame:
    """Set ``column`` where ``condition`` is true, one pass without a shuffle."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(condition, value.cast(kind)).otherwise(F.col(column)))


def raise_prices(products: DataFrame, category: str = "Electronics", factor: str = "1.10") -> DataFrame:
    return update_where(products, F.col("category") == category, "price", scaled(F.col("price"), factor))


def raise_salaries(employees: DataFrame, as_of: Moment, years: int = 5, factor: str = "1.15") -> DataFrame:
    """Raise the salary of those hired at least ``years`` before ``as_of``."""
    long_enough = F.col("hire_date") <= before(as_of, years=years)
    return update_where(employees, long_enough, "salary", scaled(F.col("salary"), factor))


def add_hire_date(employees: DataFrame, as_of: Moment, years: int = 6) -> DataFrame:
    """Add the column ``hire_date``; stored rows get the date ``years`` before ``as_of``."""
    return employees.withColumn("hire_date", before(as_of, years=years).cast("date"))


def refresh_stock(products: DataFrame, shipments: DataFrame, mode: str = "fail") -> Change:
    """Set the stock of delivered products to the level they were delivered with.

    The list may name a product several times, but only with one level, and no level may be below 0. Such a
    product raises in mode ``fail``; in ``quarantine`` it keeps its stock and is returned. Unknown products
    and rows without a product are ignored. The list is grouped once; both sides then meet by product.
    """
    levels = F.count("new_stock")
    grouped = shipments.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.min("new_stock").alias("new_stock"),
        ((F.min("new_stock") != F.max("new_stock")) | ((levels > 0) & (levels < F.count(F.lit(1))))).alias("_several"))
    rules = [("several levels", F.col("_several")), ("check stock >= 0", F.col("new_stock") < 0)]
    news = materialize(tag_rows(grouped, rules).drop("_several"), "shipments")
    given = news.select(F.col("product_id").alias("_product"), F.col("new_stock").alias("_level"), VIOLATIONS)
    joined = products.join(given, F.col("product_id") == F.col("_product"), "left")
    broken = F.size(VIOLATIONS) > 0
    message = F.concat(F.lit("stock refused: product "), F.col("product_id").cast("string"), F.lit(", "),
                       F.array_join(VIOLATIONS, ", "))
    kept = F.raise_error(message) if mode == "fail" else F.col("stock")
    stock = F.when(F.col("_product").isNull(), F.col("stock")).when(broken, kept).otherwise(F.col("_level"))
    state = joined.select(*[stock.cast("int").alias(c) if c == "stock" else F.col(c) for c in products.columns])
    known = news.join(products.select("product_id"), "product_id", "left_semi")
    return Change(state, known.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), known.filter(broken))


def add_stock(products: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Add delivered quantities to the stock; NULL stock stays NULL, a result below 0 raises.

    Deliveries are summed per product first, then the rule holds for the sum.
    """
    sums = deliveries.groupBy(F.col("product_id").alias("_product")).agg(F.sum("quantity").alias("_more"))
    joined = products.join(sums, F.col("product_id") == F.col("_product"), "left")
    level = F.when(F.col("_product").isNull(), F.col("stock")).otherwise(F.col("stock") + F.col("_more"))
    message = F.concat(F.lit("stock below 0: product "), F.col("product_id"))
    checked = F.when(level < 0, F.raise_error(message)).otherwise(level).cast("int")
    return joined.select(*[checked.alias(c) if c == "stock" else F.col(c) for c in products.columns])


def update_customers(customers: DataFrame, changes: DataFrame, mode: str = "fail") -> Change:
    """Replace name, email, phone and city of the listed customers under the rules of the table.

    Unknown customers are ignored. Refused are all changes of a customer who is named more than once, changes
    against a row rule (a NULL overwrites), and changes to an email or phone that, after all sound changes,
    another row holds. Mode ``fail`` then refuses the whole list. In ``quarantine`` the refused rows keep
    their values, so if any were refused for an email or phone, the other changes must not take a value
    that any other row held before either: two passes settle everything, however the changes hang together.
    """
    table, key = TABLES["customers"], "customer_id"
    known = keys_present(customers, key, changes, key).withColumnRenamed(key, "_known")
    listed = lookup_join(changes.select(*table.columns.names), known, key, "_known", "left_semi")
    counts = listed.groupBy(F.col(key).alias("_named")).agg(F.count(F.lit(1)).alias("_times"))
    repeated = written(counts.filter("_times > 1"), "repeated")
    joined = lookup_join(listed, repeated, key, "_named", "left", table.columns.names)
    tagged = tag_rows(joined, [(f"repeated {key}", F.col("_times").isNotNull()), *row_rules(table)])
    tagged = written(tagged.select(*table.columns.names, VIOLATIONS), "changes")
    refused = tagged.filter(F.size(VIOLATIONS) > 0)
    sound = tagged.filter(F.size(VIOLATIONS) == 0)
    held = held_values(customers, sound, table.unique, key)
    judged = tag_held(sound, held, table.unique, key, freed=True)
    taken = judged.filter(F.size(VIOLATIONS) > 0)
    if mode == "fail":
        refuse_if_any(refused.unionByName(taken), f"update of {table.name} refused")
    elif row_count(judged) and not taken.isEmpty():
        judged = tag_held(sound, held, table.unique, key, freed=False)
        taken = judged.filter(F.size(VIOLATIONS) > 0)
    accepted = judged.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    fields = [c for c in table.columns.names if c != key]
    news = accepted.select(F.col(key).alias("_customer"), *[F.col(c).alias(f"_new_{c}") for c in fields])
    placed = lookup_join(customers, news, key, "_customer", "left", hot=None)
    state = placed.select(*[
        F.when(F.col("_customer").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in customers.columns
    ])
    return Change(state, accepted, refused.unionByName(taken))


# ---- deletes ---------------------------------------------------------------------------


def delete_by_key(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose primary ``key`` is not among ``keys``."""
    gone = keys.select(F.col(key).alias("_gone"))
    return lookup_join(df, gone, key, "_gone", "left_anti", hot=None)


def delete_customers(customers: DataFrame, orders: DataFrame, keys: DataFrame, mode: str = "fail") -> Change:
    """Delete customers without orders. Customers with orders are refused: in mode ``fail`` that
    is an error, in ``quarantine`` they stay and are returned. Unknown keys change nothing."""
    buying = keys_present(orders, "customer_id", keys, "customer_id").select(F.col("customer_id").alias("_buying"))
    refused = keys.join(buying, F.col("customer_id") == F.col("_buying"), "left_semi")
    if mode == "fail" and not refused.isEmpty():
        raise RuleBroken("cannot delete customers that have orders")
    free = keys.join(buying, F.col("customer_id") == F.col("_buying"), "left_anti")
    return Change(delete_by_key(customers, "customer_id", free), free, refused)


def unset_references(df: DataFrame, column: str, gone: DataFrame, key: str) -> DataFrame:
    """Set ``column`` to NULL where it refers to a deleted key."""
    deleted = gone.select(F.col(key).alias("_gone")).distinct()
    own = [c for c in df.columns if c.endswith("_id") and c != column][:1]
    joined = lookup_join(df, deleted, column, "_gone", "left", own)
    value = F.when(F.col("_gone").isNull(), F.col(column)).alias(column)
    return joined.select(*[value if c == column else F.col(c) for c in df.columns])


def append_audit(audit: DataFrame, deleted: DataFrame, as_of: Moment) -> DataFrame:
    """The audit table with one more row per deleted employee."""
    rows = prepare(audit, audit_rows(deleted, as_of), TABLES["employee_audit"], ["employee_id"], as_of)
    return audit.unionByName(rows)


def delete_employees(employees: DataFrame, audit: DataFrame, keys: DataFrame, as_of: Moment) -> Change:
    """Delete employees: (remaining employees, audit with the deleted ones, nothing refused).

    Those who reported to a deleted employee keep their row without a manager.
    """
    gone = keys.select(F.col("employee_id").alias("_gone"))
    deleted = lookup_join(employees, gone, "employee_id", "_gone", "left_semi", hot=None)
    left = delete_by_key(employees, "employee_id", keys)
    left = unset_references(left, "manager_id", keys, "employee_id")
    return Change(left, append_audit(audit, deleted, as_of), keys.limit(0))


# Parents before children along the references.
DELETE_ORDER = ("stores", "suppliers", "customers", "employees", "products", "orders", "order_items", "payments")


def cascade_delete(tables: Mapping[str, DataFrame], doomed: Mapping[str, DataFrame],
                   as_of: Moment = None) -> dict[str, DataFrame]:
    """New states of all tables after deleting the keys in ``doomed`` (table name to key column).

    A deleted row takes the rows that refer to it with it, and theirs in turn, or loses them their
    reference where that is the rule. Deleted employees are added to ``employee_audit`` if it is
    among the tables. The deleted keys of a table that others refer to are written once and used
    for all of them.
    """
    states = dict(tables)
    gone = {name: _Gone(keys.distinct()) for name, keys in doomed.items()}
    for place, name in enumerate(DELETE_ORDER):
        if name not in tables:
            continue
        table, rows = TABLES[name], tables[name]
        causes = [(table.key, gone[name])] if name in gone else []
        for reference in table.references:
            if reference.on_delete == "cascade" and reference.parent in gone:
                causes.append((reference.column, gone[reference.parent]))
        if not causes:
            continue
        # The rows of one cause are looked for twice: to keep the others and to pass their keys on.
        measured = {column: None if cause.reaches_scan or column == table.key else hot_keys(rows, column)
                    for column, cause in causes}

        def hit(source: DataFrame, column: str, cause: _Gone, how: str) -> DataFrame:
            spread = [table.key] if table.key in source.columns else source.columns
            return lookup_join(source, cause.as_column("_own"), column, "_own", how, spread, cause.small,
                               measured[column], cause.bitmap)

        kept = rows
        for column, cause in causes:
            kept = hit(kept, column, cause, "left_anti")
        audited = name == "employees" and "employee_audit" in tables
        referring = [r for later in DELETE_ORDER[place:] if later in tables
                     for r in TABLES[later].references if r.parent == name]
        if audited or (referring and [column for column, _ in causes] != [table.key]):
            deleted = hit(rows, *causes[0], "left_semi")
            for cause in causes[1:]:
                deleted = deleted.unionByName(hit(rows, *cause, "left_semi"))
            if len(causes) > 1:  # a row may go for several reasons
                deleted = deleted.dropDuplicates([table.key])
            deleted = materialize(deleted if audited else deleted.select(table.key), "deleted")
            gone[name] = _Gone(deleted.select(table.key))
            if audited:
                states["employee_audit"] = append_audit(tables["employee_audit"], deleted, as_of)
        for reference in referring:
            if reference.on_delete == "set null":
                kept = unset_references(kept, reference.column, gone[name].keys, reference.parent_key)
        states[name] = kept
    return states


class _Gone:
    """Deleted keys of one table, measured once; many of them are sent to the scans as a bitmap."""

    def __init__(self, keys: DataFrame):
        self.keys = keys
        self.small = fits_broadcast(keys)
        self.bitmap = None if self.small else key_bitmap(keys, keys.columns[0])
        self.reaches_scan = self.small or self.bitmap is not None

    def as_column(self, name: str) -> DataFrame:
        return self.keys.select(F.col(self.keys.columns[0]).alias(name))


def delete_stale_customers(tables: Mapping[str, DataFrame], as_of: Moment, years: int = 2) -> dict[str, DataFrame]:
    """Delete customers with no order, or with any undated order or order older than ``years``,
    and all that refers to them. (Where only the customers that stay are wanted,
    ``relational.active_customers`` gives them in one job.)"""
    stale = stale_customers(tables["customers"], tables["orders"], as_of, years).select("customer_id")
    return cascade_delete(tables, {"customers": materialize(stale, "stale")}, as_of)
