"""Filter interaction audit: what each filter removes in every order of application, and its fair share.

Applying a set S of filters removes the documents that fail at least one of them; their number v(S) is the game. A
filter put behind the set S removes v(S with it) - v(S) documents, so the differences of the 2^k coalitions give every
step of all k! orders; no order is ever run over the documents. The Hart-Mas-Colell potential,

    P(S) = (v(S) + sum over i in S of P(S without i)) / |S|,   P(empty) = 0,

gives the Shapley value of a filter as P(all) - P(all without it). It is kept times k!, where every P is a whole number.

1. One pass over the texts notes the text filters that a row fails, as bits of a mask, and a digest of the text.
2. Rows are counted by id, digest, part and mask, take their labels by id, and are counted again by digest, part, mask
   and labels with the least id: a text that fills a third of the table becomes a few rows before it meets its copies.
3. A row fails the copies filter if its text is also that of a smaller id. Per digest the least id over all counted
   rows decides; rows are counted, never compared with each other.
4. Counts by part and mask are summed to coalitions. Only these sums, 2^k numbers per part, meet the orders.

Nulls: a null text is empty, a null part an empty string, a null id has no label and no smaller id, and is not smaller
than any. Labels that are null or missing count as 0; of repeated labels the largest counts. Rows that repeat an id and
a text are not copies of each other, since neither id is smaller. Texts are read whole, of any length. An empty table
gives an empty result. Columns other than those named are not read, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.session import materialize

BLANK = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"
COPIES = "E"


def _words(text: Column) -> tuple[Column, Column]:
    """Numbers of words and of distinct words."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    parts, none = F.split(trimmed, f"[{BLANK}]+"), (trimmed == "").cast("int")
    return F.size(parts) - none, F.size(F.array_distinct(parts)) - none


#: Letter to the condition under which a text fails.
FILTERS: dict[str, Callable[[Column], Column]] = {
    "A": lambda text: _words(text)[0] < 200,
    "B": lambda text: 100 * _words(text)[1] < 50 * _words(text)[0],
    "C": lambda text: 100 * (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 2 * F.length(text),
    "D": lambda text: text.rlike(r"[#$%&*|]"),
}


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
             filters: dict[str, Callable[[Column], Column]] = FILTERS) -> DataFrame:
    """doc_id, part, mask (bit i: fails the i-th text filter), digest and n, the number of such rows."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    mask = reduce(lambda a, b: a + b, [fails(F.col("text")).cast("int") * (1 << i) for i, fails in enumerate(filters.values())])
    held = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
                       text.alias("text"))
    return held.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
                       ).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                filters: dict[str, Callable[[Column], Column]] = FILTERS) -> DataFrame:
    """part, mask (the copies filter is its highest bit), n, good and toxic: documents by what they fail."""
    facts = materialize(failures(docs, id_col, text_col, part_col, filters), "failures")
    one = lambda c: F.max((F.col(c) == 1).cast("int")).alias(c)
    marks = materialize(labels.where("doc_id IS NOT NULL").select("doc_id", "quality", "toxic").groupBy("doc_id").agg(
        one("quality"), one("toxic")), "marks")
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    marked = facts.join(marks, "doc_id", "left").select("doc_id", "part", "mask", "digest", "n", flag("quality"), flag("toxic"))
    # rows of one id, part, mask and text are one row here, so n beside the least id is the number of rows with it
    known = F.col("doc_id").isNotNull()
    groups = materialize(
        marked.groupBy("digest", "part", "mask", "quality", "toxic").agg(
            F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("no_id"),
            F.min(F.when(known, F.struct("doc_id", "n"))).alias("least")), "groups")
    firsts = materialize(groups.groupBy("digest").agg(F.min("least.doc_id").alias("first_id"), F.sum("n").alias("copies"))
                         .where("copies > 1").select("digest", "first_id"), "firsts")
    first_id = F.coalesce("first_id", "least.doc_id")
    spared = F.col("no_id") + F.when(F.col("least.doc_id") == first_id, F.col("least.n")).otherwise(0)
    bit = 1 << len(filters)
    split = groups.join(firsts, "digest", "left").withColumn("spared", spared).select(
        "part", "quality", "toxic", F.inline(F.array(
            F.struct(F.col("mask"), F.col("spared").alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("spared")).alias("n")))))
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("quality")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def coalition_values(counts: DataFrame, k: int) -> DataFrame:
    """Per part: n, and the games removed, good and toxic as arrays of their values v(S) by coalition number S."""
    hit = lambda c: F.array(*(
        F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0)) for s in range(1 << k)))
    return counts.groupBy("part").agg(F.sum("n").alias("n"), hit("n").alias("removed"), hit("good").alias("good"),
                                      hit("toxic").alias("toxic"))


def with_potentials(values: DataFrame, k: int, game: str = "removed") -> DataFrame:
    """``values`` with ``potential``: P(S) times k! by coalition number; the recursion goes up by the size of S."""
    whole = factorial(k)
    values = values.withColumn("p0", F.lit(0).cast("long"))
    for size in range(1, k + 1):
        sets = [s for s in range(1 << k) if s.bit_count() == size]
        values = values.withColumns({f"p{s}": F.expr(
            f"({whole} * {game}[{s}] + {' + '.join(f'p{s ^ (1 << i)}' for i in range(k) if s >> i & 1)}) div {size}") for s in sets})
    names = [f"p{s}" for s in range(1 << k)]
    return values.withColumn("potential", F.array(*names)).drop(*names)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          filters: dict[str, Callable[[Column], Column]] = FILTERS) -> DataFrame:
    """One row per part, order of the filters (text filters and the copies filter) and step, see the names below.

    The result has k * k! rows per part, so k, the number of filters, is small: it is at most 6.
    """
    letters = [*filters, COPIES]
    k = len(letters)
    if k > 6 or len(set(letters)) < k:
        raise ValueError(f"at most 6 filters with different letters, not {letters}")
    values = with_potentials(coalition_values(mask_counts(docs, labels, id_col, text_col, part_col, filters), k), k)
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": "".join(letters[j] for j in order), "step": step, "before": before, "own": 1 << i})
            before |= 1 << i
    kind = "array<struct<filter_order: string, step: int, before: int, own: int>>"
    rows = values.select("*", F.inline(F.from_json(F.lit(json.dumps(steps)), kind)))
    at = lambda c, s: F.get(c, s)
    after, full = F.col("before") + F.col("own"), F.lit((1 << k) - 1)
    lost = {c: at(c, after) - at(c, F.col("before")) for c in ("removed", "good", "toxic")}
    return rows.select(
        "part", "filter_order", "step", (F.col("n") - at("removed", after)).alias("kept"), lost["removed"].alias("removed"),
        (at("removed", F.col("own")) - lost["removed"]).alias("redundant"),
        (at("removed", full) - at("removed", full - F.col("own"))).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"),
        (at("potential", full) - at("potential", full - F.col("own"))).alias("shapley"))
