"""Mixing sources to target weights by temperature.

Each source's share of all tokens (runs of non-blank characters) is raised to an exponent between 0 and 1 and the
results are normalised. The exponent is found by bisection: the largest for which the entropy of the weights reaches
``entropy`` nats, or the smallest for which no source is repeated more than ``max_repeats`` times. The token
budget is the least at which every source is used once in full, so nothing is thrown away, unless
``budget_tokens`` names another.

A source that is to be used r times is read in full floor(r) times; of the next round it gives the first
(r - floor(r)) of its tokens. Every round has its own permutation: blocks of documents in hashed order, and
documents in hashed order within their block. The cut of the last round is found per block, then per slice of the
block where it falls, then per document, so no task orders a whole source; the round never exceeds its budget.
Only DataFrame functions are used; a source that holds most rows is summed per block before anything is ordered.

Null sources are one source. Null and empty texts have no tokens; a source without tokens is used once. Rows that
repeat an id and a text share a place and stay together. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.session import materialize

LEVELS = 5  # halvings of the exponent's interval per pass over the sources
PASSES = 8


@dataclass
class Temperature:
    """What the bisection found."""

    exponent: float
    entropy: float
    max_repeats: float


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """(source, tokens) of a table with ``source`` and ``n_tokens``."""
    return docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))


def find_exponent(totals: DataFrame, entropy: float | None = None, max_repeats: float | None = None) -> Temperature:
    """Bisect the exponent over the table of sources; each pass settles ``LEVELS`` halvings at once."""
    if (entropy is None) == (max_repeats is None):
        raise ValueError("name either an entropy or a repetition limit")
    used = totals.where("tokens > 0")
    bounds = used.agg(F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    if bounds["most"] is None:
        return Temperature(1.0, 0.0, 1.0)
    most, least = bounds["most"], bounds["least"]

    def measured(exponents: list[float]) -> list[tuple[float, float]]:
        """(entropy, largest repetition) for each exponent, in one pass."""
        sums = []
        for i, a in enumerate(exponents):
            part = F.pow(F.col("tokens") / F.lit(float(most)), F.lit(a))
            sums += [F.sum(part).alias(f"s{i}"), F.sum(part * F.log(part)).alias(f"l{i}")]
        row = used.agg(*sums).first()
        return [(math.log(row[f"s{i}"]) - row[f"l{i}"] / row[f"s{i}"], (least / most) ** (a - 1))
                for i, a in enumerate(exponents)]

    def fine(found: tuple[float, float]) -> bool:
        """Entropy falls with the exponent, repetition too."""
        return found[0] >= entropy if entropy is not None else found[1] <= max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    at_low, at_high = (fine(x) for x in measured([low, high]))
    if entropy is not None:  # the largest exponent that is still fine
        if at_high or not at_low:
            low = high = 1.0 if at_high else 0.0
    elif at_low or not at_high:  # the smallest exponent that is fine
        low = high = 0.0 if at_low else 1.0
    for _ in range(PASSES if low < high else 0):
        inner = 2 ** LEVELS
        grid = [low + (high - low) * i / inner for i in range(1, inner)]
        right = [fine(x) for x in measured(grid)]
        step = (high - low) / inner
        passed = sum(right) if entropy is not None else sum(not x for x in right)
        low, high = low + passed * step, low + (passed + 1) * step
    exponent = low if entropy is not None else high
    (found, repeats), = measured([exponent])
    return Temperature(exponent, found, repeats)


def source_plan(totals: DataFrame, exponent: float, budget_tokens: float | None = None) -> DataFrame:
    """(source, tokens, weight, repeats, rounds, part): full rounds, and tokens of the round after them."""
    most = totals.agg(F.max("tokens")).first()[0] or 1
    raised = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(most)), F.lit(exponent))).otherwise(0.0)
    weighed = totals.withColumn("raised", raised)
    total = weighed.agg(F.sum("raised")).first()[0] or 1.0
    budget = budget_tokens if budget_tokens is not None else most * total
    repeats = F.when(F.col("tokens") > 0, F.col("weight") * F.lit(float(budget)) / F.col("tokens")).otherwise(1.0)
    return (
        weighed.withColumn("weight", F.col("raised") / F.lit(float(total)))
        .withColumn("repeats", F.round(repeats, 9)).withColumn("rounds", F.floor("repeats"))
        .withColumn("part", F.floor((F.col("repeats") - F.col("rounds")) * F.col("tokens"))).drop("raised"))


def _placed(docs: DataFrame, epoch: Column, seed: int, blocks: int) -> DataFrame:
    """``docs`` (with ``mark``, a hash of the row) with its block's and its own place in the given round."""
    block = F.pmod("mark", F.lit(blocks))
    return (
        docs.withColumn("block_place", F.xxhash64(F.lit(seed), epoch.cast("long"), block))
        .withColumn("place", F.xxhash64(F.lit(seed), epoch.cast("long"), F.col("mark")))
        .withColumn("slice", F.shiftright("place", 54)))


def _cut(groups: DataFrame, place: str, name: str) -> DataFrame:
    """Per source the first place at which the tokens so far exceed ``room``, and the room left before it."""
    so_far = Window.partitionBy("source").orderBy(place).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = groups.withColumn("so_far", F.sum("tokens").over(so_far)).where("so_far > room")
    first = F.min(F.struct(place, (F.col("room") - F.col("so_far") + F.col("tokens")).alias("left")))
    return summed.groupBy("source").agg(first.alias("first")).select(
        "source", F.col(f"first.{place}").alias(name), F.col("first.left").alias("room"))


def mixing_plan(sized: DataFrame, plan: DataFrame, seed: int = 17, blocks: int = 1024) -> DataFrame:
    """``plan`` with the cut of each source's last round: cut_block, cut_slice, cut_place.

    ``sized`` has source, n_tokens and mark. A null cut_block means the whole round fits.
    """
    def same(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
        b = b.withColumnRenamed("source", "its_source")
        return a.join(b, a["source"].eqNullSafe(b["its_source"]), how).drop("its_source")

    last = plan.where("part > 0").select("source", "rounds", F.col("part").alias("room"))
    placed = _placed(same(sized, last), F.col("rounds") + 1, seed, blocks)
    per_block = placed.groupBy("source", "block_place").agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room"))
    cut_block = materialize(_cut(per_block, "block_place", "cut_block"), "cuts")
    inside = same(placed.drop("room"), cut_block).where("block_place = cut_block")
    per_slice = inside.groupBy("source", "slice").agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room"))
    cut_slice = materialize(_cut(per_slice, "slice", "cut_slice"), "cuts")
    rest = same(inside.drop("room"), cut_slice).where("slice = cut_slice")
    per_place = rest.groupBy("source", "place").agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room"))
    cut_place = materialize(_cut(per_place, "place", "cut_place"), "cuts")
    out = plan
    for cuts in (cut_block, cut_slice, cut_place):
        out = same(out, cuts.drop("room"), "left")
    return out


def mix(docs: DataFrame, max_repeats: float | None = 2.0, entropy: float | None = None,
        budget_tokens: float | None = None, seed: int = 17, blocks: int = 1024, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """One row per use of a document: the columns ``keep`` (all), then mix_epoch, mix_block and mix_place.

    Reading the rows by these three gives the mixture. Names that ``docs`` has already are refused.
    """
    added = ["mix_epoch", "mix_block", "mix_place"]
    if set(added) & set(docs.columns):
        raise ValueError(f"docs has some of {added} already")
    mark = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    sized = materialize(docs.select(
        F.col(f"`{source_col}`").alias("source"), token_count(F.col(f"`{text_col}`")).alias("n_tokens"),
        mark.alias("mark")), "sized")
    totals = materialize(source_totals(sized), "totals")
    found = find_exponent(totals, entropy, None if entropy is not None else max_repeats)
    plan = materialize(mixing_plan(sized, materialize(source_plan(totals, found.exponent, budget_tokens), "plan"),
                                   seed, blocks), "plan")
    names = keep or docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{source_col}`").alias("source"),
                        mark.alias("mark"))
    plan = plan.withColumnRenamed("source", "its_source")
    planned = whole.join(plan, whole["source"].eqNullSafe(plan["its_source"]))
    # one row per round the source takes part in, then the cut of the last one
    rounds = F.col("rounds") + F.when(F.col("part") > 0, 1).otherwise(0)
    uses = planned.where(rounds >= 1).withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), rounds.cast("long"))))
    uses = _placed(uses, F.col("epoch"), seed, blocks)
    before = F.coalesce(
        (F.col("block_place") < F.col("cut_block"))
        | ((F.col("block_place") == F.col("cut_block")) & F.coalesce(
            (F.col("slice") < F.col("cut_slice"))
            | ((F.col("slice") == F.col("cut_slice")) & F.coalesce(F.col("place") < F.col("cut_place"), F.lit(True))),
            F.lit(True))),
        F.lit(True))
    return uses.where((F.col("epoch") <= F.col("rounds")) | before).select(
        "row.*", F.col("epoch").cast("int").alias("mix_epoch"), F.col("block_place").alias("mix_block"),
        F.col("place").alias("mix_place"))
