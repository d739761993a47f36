"""Rules of stored data as jobs over whole tables.

A rule on one row (required, length, check) is a column expression; all of them are tested in
one pass. A rule on keys groups by the key first, so that the many copies of one key shrink on
the map side. A rule with a NULL operand holds, as in SQL: only a FALSE outcome is a violation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.operators.keyed import fits_broadcast, hot_keys, lookup_join, row_count, sized_like, written
from tillmark.schema import Reference, Table

VIOLATIONS = "violations"


class RuleBroken(ValueError):
    """A statement was refused because rows break rules."""


def required_rules(table: Table) -> list[tuple[str, Column]]:
    return [(f"required {c}", F.col(c).isNull()) for c in table.required]


def length_rules(table: Table) -> list[tuple[str, Column]]:
    """Length counts characters, not bytes."""
    return [(f"length {c}", F.length(c) > n) for c, n in table.lengths]


def check_rules(table: Table) -> list[tuple[str, Column]]:
    return [(f"check {text}", ~F.expr(text)) for text in table.checks]


def row_rules(table: Table) -> list[tuple[str, Column]]:
    return required_rules(table) + length_rules(table) + check_rules(table)


def tag_rows(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add the names of the violated rules as an array column; one pass, no shuffle."""
    none = F.array().cast("array<string>")
    broken = [F.when(violated, F.array(F.lit(name))).otherwise(none) for name, violated in rules]
    return df.withColumn(VIOLATIONS, F.concat(none, *broken))


def row_violations(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per input row and violated rule, with the rule's name in ``rule``.

    Sound rows are filtered out first, so that only the others are unfolded.
    """
    any_broken = F.lit(False)
    for _, violated in rules:
        any_broken = any_broken | F.coalesce(violated, F.lit(False))
    names = F.array(*[F.when(violated, F.lit(name)) for name, violated in rules])
    unfolded = df.filter(any_broken).select(*df.columns, F.explode(names).alias("rule"))
    return unfolded.filter(F.col("rule").isNotNull())


def count_violations(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """``rule`` and ``n_rows`` of every violated rule, counted in one pass."""
    counts = df.agg(*[F.count_if(violated).alias(f"_{n}") for n, (_, violated) in enumerate(rules)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"_{n}").alias("n_rows")) for n, (name, _) in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs))).filter("n_rows > 0")


def repeated_keys(df: DataFrame, keys: Sequence[str], nulls_allowed: bool) -> DataFrame:
    """Keys held by several rows, with ``n_rows``; also keys with a NULL unless these are allowed.

    A primary key allows no NULL; under a unique rule NULLs never collide.
    """
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    source = df.filter(~has_null) if nulls_allowed else df
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | has_null)


def broken_references(df: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """Values of the reference that no parent has, with ``n_rows``. NULL refers to nothing and passes.

    Rows are counted per value before the join, so a frequent value is one row in it.
    """
    used = df.groupBy(reference.column).agg(F.count(F.lit(1)).alias("n_rows"))
    held = parent.select(F.col(reference.parent_key).alias("_held"))
    return used.filter(F.col(reference.column).isNotNull()).join(
        held, F.col(reference.column) == F.col("_held"), "left_anti")


def key_rules(table: Table) -> list[tuple[str, str]]:
    return [("primary key", table.key)] + [(f"unique {c}", c) for c in table.unique]


def violations(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """All violations of a stored table as ``rule``, ``value``, ``n_rows``.

    References to tables that are not in ``parents`` are not tested.
    """
    found = df.sparkSession.createDataFrame([], "rule string, value string, n_rows bigint")
    if row_rules(table):
        counted = count_violations(df, row_rules(table))
        found = counted.select("rule", F.lit(None).cast("string").alias("value"), "n_rows")
    for name, key in key_rules(table):
        repeated = repeated_keys(df, [key], nulls_allowed=key != table.key)
        found = found.unionByName(
            repeated.select(F.lit(name).alias("rule"), F.col(key).cast("string").alias("value"), "n_rows"))
    for reference in table.references:
        if reference.parent in parents:
            broken = broken_references(df, reference, parents[reference.parent])
            found = found.unionByName(broken.select(
                F.lit(f"reference {reference.column}").alias("rule"),
                F.col(reference.column).cast("string").alias("value"), "n_rows"))
    return found


ARRIVAL = "_arrival"  # place of arrival, written with the rows


def with_arrival(batch: DataFrame, label: str = "batch") -> DataFrame:
    """The batch, written down, with each row's place of arrival."""
    return written(batch.withColumn(ARRIVAL, F.monotonically_increasing_id()), label)


def in_order(batch: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """The batch, written down, with its turn: by ``order_by``, then by place of arrival."""
    arrived = with_arrival(batch)
    turn = F.struct(*order_by, ARRIVAL) if order_by else F.col(ARRIVAL)
    return sized_like(arrived.withColumn("_turn", turn).drop(ARRIVAL), arrived)


def key_values(df: DataFrame, columns: Sequence[str], *extra: str | Column) -> DataFrame:
    """One row ``_column``, ``_value`` per unique column of each row, NULLs left out: all unique
    columns are then tested in one pass over the table."""
    pairs = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)), *extra).filter(F.col("_value").isNotNull())


def value_turns(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per unique column and value of the batch: its rows and the turn of the first of them."""
    grouped = key_values(batch, columns, "_turn").groupBy("_column", "_value")
    return written(grouped.agg(F.min("_turn").alias("_first"), F.count(F.lit(1)).alias("_rows")), "turns")


def stored_values(existing: DataFrame, columns: Sequence[str], turns: DataFrame) -> DataFrame:
    """Those values of ``turns`` that the ``existing`` rows hold.

    The values of a small batch are sent to the scan of the stored table, which is then filtered
    where it is read; a large batch is joined to it on the values.
    """
    wanted, held = turns.select("_column", "_value"), key_values(existing, columns)
    if fits_broadcast(turns):
        found = held.join(F.broadcast(wanted), ["_column", "_value"], "left_semi").distinct()
    else:
        found = wanted.join(held, ["_column", "_value"], "left_semi")
    return written(found, "stored")


def values_of(clashes: DataFrame, column: str, like: DataFrame) -> DataFrame:
    """The clashing values of one column, in its own type, as ``_clash``."""
    value = F.col("_value").cast(like.schema[column].dataType).alias("_clash")
    rest = [c for c in clashes.columns if c not in ("_column", "_value")]
    return clashes.filter(F.col("_column") == column).select(value, *rest)


class Probe(NamedTuple):
    """A rule that is decided by looking a column's value up: a key (``parent`` is None) or a reference."""

    name: str
    column: str
    parent: DataFrame | None = None
    parent_key: str = ""


def probes_of(table: Table, parents: Mapping[str, DataFrame], settled: Sequence[str] = ()) -> list[Probe]:
    """The keys of ``table`` but for the ``settled`` columns, then its references to the given parents."""
    keys = [Probe(name, column) for name, column in key_rules(table) if column not in settled]
    return keys + [Probe(f"reference {r.column}", r.column, parents[r.parent], r.parent_key)
                   for r in table.references if r.parent in parents]


def _kind(df: DataFrame, columns: Sequence[str]) -> str:
    kinds = {df.schema[c].dataType.simpleString() for c in columns if c}
    return kinds.pop() if len(kinds) == 1 else "string"


def _probe_values(df: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    """``_rule`` (number of the probe) and ``_value`` of each row, NULLs left out; values of several types are texts."""
    kind = _kind(df, columns)
    pairs = [F.struct(F.lit(n).alias("_rule"), F.col(c).cast(kind).alias("_value")) for n, c in enumerate(columns) if c]
    return df.select(F.inline(F.array(*pairs)), *extra).filter(F.col("_value").isNotNull())


def breaches(batch: DataFrame, probes: Sequence[Probe], existing: DataFrame | None) -> DataFrame:
    """``_rule``, ``_value``, ``_first`` (turn) and ``_held`` of the values that break a rule for some row of the batch.

    All keys and references are looked up at once: the batch unfolds into (rule, value) entries, which are reduced to
    one row per value, and meet the entries of the stored rows and of the parents in one grouping. The entries of a
    small batch are sent to the scans, so that only those asked for leave them.
    """
    columns = [p.column for p in probes]
    kind = _kind(batch, columns)
    grouped = _probe_values(batch, columns, "_turn").groupBy("_rule", "_value")
    wanted = written(grouped.agg(F.min("_turn").alias("_first"), F.count(F.lit(1)).alias("_rows")), "wanted")
    held = []
    if existing is not None and any(p.parent is None for p in probes):
        held.append(_probe_values(existing, [p.column if p.parent is None else "" for p in probes]))
    for n, probe in enumerate(probes):
        if probe.parent is not None:
            key = F.col(probe.parent_key).cast(batch.schema[probe.column].dataType).cast(kind)
            held.append(probe.parent.select(F.lit(n).alias("_rule"), key.alias("_value")).filter(F.col("_value").isNotNull()))
    met = wanted.withColumn("_held", F.lit(False))
    small = fits_broadcast(wanted)
    for entries in held:
        entries = entries.withColumn("_value", F.col("_value").cast(kind))
        if small:
            entries = entries.join(F.broadcast(wanted.select("_rule", "_value")), ["_rule", "_value"], "left_semi")
        met = met.unionByName(entries.withColumn("_held", F.lit(True)), allowMissingColumns=True)
    met = met.groupBy("_rule", "_value").agg(F.min("_first").alias("_first"), F.max("_rows").alias("_rows"), F.max("_held").alias("_held"))
    refers = F.col("_rule").isin([n for n, p in enumerate(probes) if p.parent is not None])
    broken = F.when(refers, ~F.col("_held")).otherwise(F.col("_held") | (F.col("_rows") > 1))
    return written(met.filter(F.col("_rows").isNotNull() & broken).drop("_rows"), "breaches")


def tag_breaches(tagged: DataFrame, found: DataFrame, probes: Sequence[Probe], key: str) -> DataFrame:
    """Add the rules that a row breaks by ``found``, in the order of the probes; ``tagged`` has a ``_turn``.

    Where few values break rules, they are sent to the rows, for the rules that occur. Many meet the rows' entries in
    one join, and each row's rules are folded back into one list.
    """
    columns = tagged.columns
    late = lambda n: F.col("_held") | (F.col("_turn") != F.col("_first")) if probes[n].parent is None else F.lit(True)
    if fits_broadcast(found):
        occurring = {r["_rule"] for r in found.select("_rule").distinct().collect()} if row_count(found) else ()
        for n, probe in enumerate(probes):
            broken = F.col(probe.column).isNull() if probe.column == key and probe.parent is None else F.lit(False)
            if n in occurring:
                own = found.filter(F.col("_rule") == n).select(
                    F.col("_value").cast(tagged.schema[probe.column].dataType).alias("_clash"), "_first", "_held")
                tagged = lookup_join(tagged, own, probe.column, "_clash", "left", small=True)
                broken = broken | (F.col("_clash").isNotNull() & late(n))
            elif not (probe.column == key and probe.parent is None):
                continue
            tagged = _with_rule(tagged, columns, broken, probe.name)
        return tagged
    entry = F.concat(F.col("_rule").cast("string"), F.lit(":"), F.col("_value").cast("string"))
    entries = _probe_values(tagged, [p.column for p in probes], "_turn").select(
        "_rule", "_turn", entry.alias("_entry"))
    met = lookup_join(entries, found.select(entry.alias("_clash"), "_first", "_held"), "_entry", "_clash", "inner", ["_turn"])
    broken = F.lit(False)
    for n in range(len(probes)):
        broken = broken | ((F.col("_rule") == n) & late(n))
    folded = met.filter(broken).groupBy(F.col("_turn").alias("_own")).agg(F.sort_array(F.collect_set("_rule")).alias("_rules"))
    names = F.array(*[F.lit(p.name) for p in probes])
    missing = F.when(F.col(key).isNull(), F.array(F.lit("primary key"))).otherwise(F.array().cast("array<string>"))
    more = F.transform(F.coalesce("_rules", F.array().cast("array<int>")), lambda n: F.get(names, n))
    keyed = any(p.column == key and p.parent is None for p in probes)
    more = F.concat(VIOLATIONS, missing, more) if keyed else F.concat(VIOLATIONS, more)
    joined = tagged.join(folded, F.col("_turn") == F.col("_own"), "left")
    return joined.select(*[more.alias(c) if c == VIOLATIONS else F.col(c) for c in columns])


def held_values(existing: DataFrame, changes: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Per unique column and value that ``changes`` set: how many changes set it (``_rows``), the stored row that
    holds it (``_holder``), and whether that row's own change gives it up (``_freed``).

    Only the values of the changes are looked up in the stored table, see ``stored_values``.
    """
    pairs = key_values(changes, columns, key)
    wanted = written(pairs.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_rows")), "wanted")
    held = key_values(existing, columns, F.col(key).alias("_holder"))
    values = wanted.select("_column", "_value")
    found = held.join(F.broadcast(values) if fits_broadcast(wanted) else values, ["_column", "_value"], "left_semi")
    now = pairs.select("_column", F.col(key).alias("_holder"), F.col("_value").alias("_now"))
    freed = F.col("_now").isNotNull() & (F.col("_now") != F.col("_value"))
    holders = found.join(now, ["_column", "_holder"], "left").withColumn("_freed", freed).drop("_now")
    return written(wanted.join(holders, ["_column", "_value"], "left"), "held")


def tag_held(tagged: DataFrame, held: DataFrame, columns: Sequence[str], key: str, freed: bool) -> DataFrame:
    """Add the unique rules that a change breaks; ``freed`` says that given-up values may be taken."""
    small = fits_broadcast(held)
    for column in columns:
        before = tagged.columns
        hot = None if small else hot_keys(tagged, column)
        tagged = lookup_join(tagged, values_of(held, column, tagged), column, "_clash", "left", before[:-1], small, hot)
        other = F.coalesce(F.col("_holder") != F.col(key), F.lit(False))
        if freed:
            other = other & ~F.col("_freed")
        tagged = _with_rule(tagged, before, (F.col("_rows") > 1) | other, f"unique {column}")
    return written(tagged, "judged")


def _with_rule(tagged: DataFrame, columns: Sequence[str], broken: Column, name: str) -> DataFrame:
    more = F.when(broken, F.array_append(VIOLATIONS, F.lit(name))).otherwise(F.col(VIOLATIONS))
    return tagged.select(*[more.alias(c) if c == VIOLATIONS else F.col(c) for c in columns])


def split_valid(batch: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None,
                existing: DataFrame | None = None, order_by: Sequence[str] = (),
                numbered: bool = False, settled: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a batch; rejected rows name their rules in ``violations``.

    Tested are the row rules and, for rows that keep them, the references to the given ``parents``, and keys
    against the ``existing`` rows and earlier such rows of the batch. ``numbered`` says that the key was just
    assigned in order beyond all stored keys: it cannot clash and gives the order. The values of the unique columns
    in ``settled`` are known not to clash.
    """
    batch = batch.withColumn("_turn", F.col(table.key)) if numbered else in_order(batch, order_by)
    columns = [c for c in batch.columns if c != "_turn"]
    probes = probes_of(table, parents or {}, [*settled, *([table.key] if numbered else [])])
    own = tag_rows(batch, row_rules(table))
    judged = own.select(*columns, VIOLATIONS)
    if probes:
        sound = own.filter(F.size(VIOLATIONS) == 0)  # only these reach the joins, and only these hold a value
        found = breaches(sound, probes, existing)
        tagged = tag_breaches(sound, found, probes, table.key)
        judged = tagged.select(*columns, VIOLATIONS).unionByName(judged.filter(F.size(VIOLATIONS) > 0))
        if not fits_broadcast(found):
            judged = written(judged, "judged")  # else judging again, without a shuffle, costs less than to write the rows
    return judged.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), judged.filter(F.size(VIOLATIONS) > 0)


def refuse_if_any(rejected: DataFrame, what: str) -> None:
    """Raise when there are rejected rows, with the number of rows per rule."""
    counted = rejected.select(F.explode(VIOLATIONS).alias("rule")).groupBy("rule").count().collect()
    if counted:
        listed = ", ".join(f"{row['rule']}: {row['count']}" for row in sorted(counted))
        raise RuleBroken(f"{what}: {listed}")
