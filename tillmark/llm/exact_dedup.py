"""Exact deduplication with a split for heavy hitters; DataFrame and SQL functions only.

Texts are equal when they are identical after lower-casing A to Z; null counts as empty. Of equal texts the row
with the largest ``doc_id`` stays (a null id sorts lowest; of rows that repeat an id and a text one stays).

1. Misra-Gries summaries (Spark's frequent-items sketch) of the digests are built per group of scan tasks and merged
   as a tree, so that no task reads more than ``branches`` summaries.
2. The candidates they name, at most ``tracked``, are counted exactly; that settles the winner of each frequent digest.
3. The winners, at most one row per candidate, are broadcast: rows of frequent digests are settled where they
   are read, without a shuffle.
4. The other digests, each below the sketch's error of about 3.5 / ``tracked`` of all rows, take one ordinary shuffle.

A digest that the sketch misses is settled in step 4 like any other: the sketch decides how rows travel, never
which rows stay. An empty table gives an empty result. Columns other than the id and the text are carried along
untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: Column) -> Column:
    """SHA-256, 32 bytes, of the text in UTF-8 with A to Z in lower case."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def frequent_candidates(keyed: DataFrame, key: str, tracked: int = 8192, branches: int = 64) -> DataFrame:
    """Hashes of keys that may be frequent, at most ``tracked``; column ``key_hash``."""
    summaries = (
        keyed.select(F.xxhash64(key).alias("key_hash"), (F.spark_partition_id() % branches).alias("branch"))
        .groupBy("branch").agg(F.expr(f"approx_top_k_accumulate(key_hash, {tracked})").alias("summary"))
    )
    summaries = materialize(summaries, "summaries")  # at most one row per branch
    if summaries.isEmpty():
        return keyed.sparkSession.createDataFrame([], "key_hash long")
    # combining fails on a task without rows, so the few rows are read by one
    merged = summaries.coalesce(1).agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
    named = merged.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {tracked})")).alias("named"))
    return named.select(F.col("named.item").alias("key_hash")).where("key_hash IS NOT NULL")


def verified_winners(keyed: DataFrame, tracked: int = 8192) -> DataFrame:
    """Exact size and winner of each digest that the summaries name and that occurs more than once."""
    candidates = materialize(frequent_candidates(keyed, "digest", tracked), "candidates")
    counted = (
        keyed.withColumn("key_hash", F.xxhash64("digest"))
        .join(F.broadcast(candidates), "key_hash", "left_semi")
        .groupBy("digest").agg(F.max(F.struct("doc_id", "row_no")).alias("winner"), F.count("*").alias("group_size"))
    )
    return materialize(counted.where("group_size > 1"), "winners")


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = 8192) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest."""
    keyed = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), text_digest(F.col(f"`{text_col}`")).alias("digest"),
        F.monotonically_increasing_id().alias("row_no")), "digests")
    winners = verified_winners(keyed, tracked)
    frequent = keyed.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    others = (
        keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("winner", F.max(F.struct("doc_id", "row_no")).over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    return frequent.unionByName(others).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("winner.row_no")).alias("kept"), "digest")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = 8192) -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Losers of frequent digests go where they are read. What is left is ranked per digest; Spark ranks within each
    task before the shuffle too, so repeated rows of one winner do not travel either.
    """
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    keyed = whole.select("row", F.col(f"row.`{id_col}`").alias("doc_id"),
                         text_digest(F.col(f"row.`{text_col}`")).alias("digest"))
    ids = materialize(keyed.select("doc_id", "digest", F.monotonically_increasing_id().alias("row_no")), "digests")
    winners = verified_winners(ids, tracked).select("digest", F.col("winner.doc_id").alias("keep_id"), F.lit(True).alias("known"))
    left = (
        keyed.join(F.broadcast(winners), "digest", "left")
        .where(F.col("known").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    )
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("row"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return ranked.select("row.*")
