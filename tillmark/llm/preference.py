"""Preference formatting of chosen and rejected conversations; DataFrame functions only.

The turns that both conversations of a pair begin with, role and text alike, are rendered once as the prompt. What
follows is rendered per side as a completion; of it the assistant's turns are trained on, all else is masked. Turns are
compared by their place in the conversation, whatever their numbers.

The result of ``preference_segments`` has one row per rendered turn: pair_id, part (prompt, chosen, rejected), place (from
0), role, rendered, n_rows, train_from and train_to, the code points of ``rendered`` that carry loss (equal where nothing
does). A training example is the prompt's rows and then the rows of one side, by place. Turns stay rows because a
conversation may be of any length: no task gathers one, a pair that holds most rows is summed before it is shuffled, and
places come from row counts of a range sort. ``preference_pairs`` gives one row per pair for all pairs of at most
``max_chars`` rendered code points; longer ones are read from the turn rows.

Null texts and roles count as empty. A null turn comes before all others. Rows that repeat a conversation, turn,
role and text are one row with their number in n_rows; several rows of one turn are compared as a set. A
conversation without a counterpart has an empty prompt; of two identical ones all is prompt. Rows whose
conversation is null belong to no pair and are left out. An empty table gives an empty result.

``answer_pairs`` makes pairs from conversations without preference labels. See there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.operators.writes import assign_keys
from tillmark.session import materialize

BEGIN, END = "<|im_start|>", "<|im_end|>"
FIRST_TURN = -(2 ** 63)


def guarded(text: Column) -> Column:
    """Text that cannot be taken for a marker of the chat format."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def with_places(turns: DataFrame) -> DataFrame:
    """``turns`` with ``place`` instead of ``turn``: 0 for a side's lowest turn, 1 for the next, and so on."""
    side = ["pair_id", "chosen"]
    once = assign_keys(turns.select(*side, "turn").distinct(), "number", [*side, "turn"])
    starts = once.groupBy(*side).agg(F.min("number").alias("start"))
    places = once.join(starts, side).select(*side, "turn", (F.col("number") - F.col("start")).alias("place"))
    return turns.join(places, [*side, "turn"]).drop("turn")


def preference_segments(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Rendered turns of all pairs; ``turns`` has pair_id, chosen (boolean), turn, role and text."""
    clean = turns.where(F.col("pair_id").isNotNull() & F.col("chosen").isNotNull()).select(
        "pair_id", F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "chosen")
    once = materialize(clean.groupBy("pair_id", "chosen", "turn", "role", "text").agg(F.count("*").alias("n")), "turns")
    counted = materialize(
        with_places(once).groupBy("pair_id", "place", "role", "text").agg(
            F.sum(F.when(F.col("chosen"), F.col("n")).otherwise(0)).alias("chosen"),
            F.sum(F.when(F.col("chosen"), 0).otherwise(F.col("n"))).alias("rejected")), "placed")
    parting = counted.where("chosen != rejected").groupBy("pair_id").agg(F.min("place").alias("parting"))
    placed = counted.join(parting, "pair_id", "left")
    shared = F.col("parting").isNull() | (F.col("place") < F.col("parting"))
    side = F.array(F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("n_rows")),
                   F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("n_rows")))
    parts = F.when(shared, F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("n_rows")))).otherwise(side)
    head = F.concat(F.lit(BEGIN), guarded(F.col("role")), F.lit("\n"))
    body = F.concat(guarded(F.col("text")), F.lit(END))
    rows = placed.withColumn("use", F.explode(parts)).where("use.n_rows > 0").select(
        "pair_id", F.col("use.part").alias("part"), "place", "role", head.alias("head"), body.alias("body"),
        F.col("use.n_rows").alias("n_rows"))
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    start = F.char_length("head").cast("long")
    return rows.select(
        "pair_id", "part", "place", "role", F.concat("head", "body", F.lit("\n")).alias("rendered"), "n_rows",
        start.alias("train_from"), F.when(trained, start + F.char_length("body")).otherwise(start).alias("train_to"))


def preference_pairs(segments: DataFrame, max_chars: int = 1 << 20) -> DataFrame:
    """One row per pair of at most ``max_chars`` rendered code points: pair_id, prompt, chosen, rejected, and the spans of
    both completions that carry loss (arrays of begin and end, counted from the completion's first code point).

    The bound keeps what one group holds small; sizes are summed before any text travels. Rows of one place follow each
    other by role and text, repeated ones as often as they are there.
    """
    fitting = segments.groupBy("pair_id").agg(
        F.sum(F.char_length("rendered") * F.col("n_rows")).alias("chars")).where(F.col("chars") <= max_chars)
    turn = F.struct("place", "role", "rendered", "n_rows", "train_from", "train_to")
    whole = segments.join(fitting.select("pair_id"), "pair_id").groupBy("pair_id", "part").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    each = whole.withColumn("turns", F.flatten(F.transform(
        "turns", lambda t: F.array_repeat(t, t["n_rows"].cast("int")))))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    begun = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(done: Column, t: Column) -> Column:
        span = F.struct((done["at"] + t["train_from"]).alias("begin"), (done["at"] + t["train_to"]).alias("end"))
        spans = F.when(t["train_to"] > t["train_from"], F.array_append(done["spans"], span)).otherwise(done["spans"])
        return F.struct((done["at"] + F.char_length(t["rendered"])).alias("at"), spans.alias("spans"))

    parts = each.select(
        "pair_id", "part", F.array_join(F.col("turns.rendered"), "").alias("text"),
        F.aggregate("turns", begun, step)["spans"].alias("spans"))
    of = lambda part, column: F.max(F.when(F.col("part") == part, F.col(column)))
    return parts.groupBy("pair_id").agg(
        *[F.coalesce(of(p, "text"), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")],
        *[F.coalesce(of(p, "spans"), none).alias(f"{p}_spans") for p in ("chosen", "rejected")])


def answer_pairs(conversations: DataFrame, answering_role: str = "assistant") -> DataFrame:
    """Turns of pairs (pair_id, chosen, turn, role, text) made from conv_id, turn, role and text.

    Each conversation up to its last answer is the chosen side of a pair named by its conv_id. The rejected side has the
    same turns, but as its last answer that of the neighbouring conversation, whose id differs in the last bit. So both
    sides share all turns before it. A conversation without an answer, or with a neighbour that has none, makes no pair.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("pair_id"), F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN)).alias("turn"),
        "role", "text")
    is_answer = F.coalesce(F.col("role"), F.lit("")) == answering_role
    last = materialize(turns.where(is_answer).groupBy("pair_id").agg(F.max("turn").alias("last")), "answers")
    neighbour = F.col("pair_id").bitwiseXOR(F.lit(1).cast("long"))
    donors = last.select(neighbour.alias("pair_id"), F.col("last").alias("donor_last"))
    paired = last.join(donors, "pair_id")
    own = turns.join(paired, "pair_id").where("turn <= last")
    given = turns.where(is_answer).join(
        paired.select(F.col("pair_id").alias("to"), F.col("last").alias("at"), neighbour.alias("pair_id"),
                      F.col("donor_last").alias("turn")), ["pair_id", "turn"])
    kept = ["pair_id", "chosen", "turn", "role", "text"]
    both = F.array(F.lit(True), F.lit(False))
    sides = F.when(is_answer & (F.col("turn") == F.col("last")), F.array(F.lit(True))).otherwise(both)
    return own.withColumn("chosen", F.explode(sides)).select(*kept).unionByName(
        given.select(F.col("to").alias("pair_id"), F.lit(False).alias("chosen"), F.col("at").alias("turn"), "role", "text"))
