"""Joins on one key against a table where that key is unique.

Every join of this library looks up rows of a large table (orders, items) in a table
with a unique key (customers, products, a set of keys). Four ways, by measured size:

1. the unique side is small (counted and weighed): broadcast it, no shuffle at all;
2. only a set of whole numbers is asked for (semi and anti joins) and its bitmap is small: broadcast
   that, 64 keys to a word, so that dense keys of a hundred million rows reach the scan;
3. no key is hot: leave the shuffle join to Catalyst and adaptive execution;
4. some keys are hot (one customer may own a third of all orders, or a third may have a
   NULL customer): rows of a hot key are spread over several salts, and only the
   matching rows of the unique side are repeated, once per salt.

Hot keys are estimated on a sample of the key column. The estimate decides how rows are
spread, never which rows come out: every row takes part in the join in all four ways.

The two sides must not share column names (rename before the join).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.session import materialize

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
BITMAP_BYTES = 64 * 1024 * 1024
BITMAP_BUCKET_BYTES = 600  # 64 words of 64 keys, and what a broadcast row costs beside them
HOT_SHARE = 0.002  # a key with a larger share of the rows is hot ...
HOT_FAIR_SHARES = 3  # ... and so is one with more rows than this many tasks get on average
HOT_SAMPLE_ROWS = 1_000_000
HOT_SAMPLE_HITS = 50  # sampled rows of a key that is just hot, at least
MEASURE = "measure"  # hot keys are to be looked for
HOT_MIN_ROWS = 500  # fewer rows than this never make a key hot

_HOT, _COPIES, _SALT = "_hot_key", "_copies", "_salt"
_BUCKET, _WORDS = "_bitmap_bucket", "_bitmap_words"


class Size(NamedTuple):
    rows: int
    text_bytes: int


_sizes: WeakKeyDictionary[DataFrame, Size] = WeakKeyDictionary()


def _text_weight(df: DataFrame) -> Column:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    weight = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in texts), F.lit(0))
    return F.coalesce(F.sum(weight.cast("bigint")), F.lit(0))


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """``materialize``, with the rows and the bytes of text counted on the way: checks of the step's size need no job."""
    seen = Observation()
    step = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows"), _text_weight(df).alias("text_bytes")), label)
    _sizes[step] = Size(**seen.get)
    return step


def sized_like(df: DataFrame, step: DataFrame) -> DataFrame:
    """``df``, which has the rows and no more text than the written ``step``."""
    _sizes[df] = _sizes[step]
    return df


def row_count(df: DataFrame) -> int:
    """The number of rows, known already of a step that was ``written``."""
    known = _sizes.get(df)
    return known.rows if known else df.count()


def fits_broadcast(df: DataFrame) -> bool:
    """Counted and weighed: few enough rows and few enough bytes to send to every executor."""
    known = _sizes.get(df)
    rows = known.rows if known else df.count()
    if rows > BROADCAST_ROWS:
        return False
    size = rows * 16 * len(df.columns)
    if known:
        size += known.text_bytes
    elif rows and any(isinstance(f.dataType, T.StringType) for f in df.schema.fields):
        size += df.agg(_text_weight(df)).first()[0]
    return size <= BROADCAST_BYTES


def key_bitmap(keys: DataFrame, key: str) -> DataFrame | None:
    """The set of whole numbers in ``keys.key`` as buckets of 64 words of 64 bits; NULLs are left out.

    None if the keys are of another type, or so thinly spread that the bitmap would be more than ``BITMAP_BYTES``: that
    is estimated before it is built, and counted when it is written.
    """
    if not isinstance(keys.schema[key].dataType, T.IntegralType):
        return None
    number = F.col(key).cast("bigint")
    line = BITMAP_BYTES // BITMAP_BUCKET_BYTES
    if keys.agg(F.approx_count_distinct(F.shiftright(number, 12), 0.02)).first()[0] > 1.1 * line:
        return None
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.filter(F.col(key).isNotNull()).groupBy(F.shiftright(number, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    place = F.col("_word").bitwiseAND(F.lit(63)).cast("int")
    buckets = words.groupBy(F.shiftright("_word", 6).alias(_BUCKET)).agg(
        F.map_from_entries(F.collect_list(F.struct(place, F.col("_bits")))).alias("_held"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_held", i), F.lit(0).cast("bigint")))
    bitmap = written(buckets.select(_BUCKET, filled.alias(_WORDS)), "bitmap")
    return bitmap if row_count(bitmap) <= line else None


def _by_bitmap(fact: DataFrame, bitmap: DataFrame, fact_key: str, how: str) -> DataFrame:
    number = F.col(fact_key).cast("bigint")
    word = F.get(F.col(_WORDS), F.shiftright(number, 6).bitwiseAND(F.lit(63)).cast("int"))
    bit = F.call_function("shiftright", word, number.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    listed = F.coalesce(bit == 1, F.lit(False))
    marked = fact.join(F.broadcast(bitmap), F.shiftright(number, 12) == F.col(_BUCKET), "left")
    return marked.filter(listed if how == "left_semi" else ~listed).drop(_BUCKET, _WORDS)


def hot_keys(df: DataFrame, key: str) -> DataFrame | None:
    """Frequent values of ``key`` (NULL included) and the number of salts for each.

    None when there is none. The line is ``HOT_SHARE`` of the rows or ``HOT_FAIR_SHARES`` average tasks,
    whichever is less, so no task of the join gets more than that of one key. At most 500 rows, or a
    third as many as there are shuffle tasks.
    """
    rows = row_count(df)
    if rows < HOT_MIN_ROWS:
        return None
    line = min(HOT_SHARE, HOT_FAIR_SHARES / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fraction = min(1.0, max(HOT_SAMPLE_ROWS, HOT_SAMPLE_HITS / line) / rows)
    sampled = rows * fraction
    seen = df.select(key)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=11)
    floor = max(HOT_MIN_ROWS * fraction, sampled * line)
    found = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= floor).collect()
    if not found:
        return None
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = [(row[0], max(2, math.ceil(2 * tasks * row[1] / sampled))) for row in found]
    schema = T.StructType([T.StructField(_HOT, df.schema[key].dataType), T.StructField(_COPIES, T.IntegerType())])
    return spark.createDataFrame(counted, schema)


def _salted(fact: DataFrame, dim: DataFrame, on: Column, fact_key: str, dim_key: str, how: str,
            hot: DataFrame, spread: Sequence[str]) -> DataFrame:
    # The salt depends on the row's own values and its input partition only, so a task that
    # is run again after a lost executor gives the same salts; copies of a row that lie in
    # different input partitions get different ones.
    place = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in spread])
    copies = F.coalesce(F.col(_COPIES), F.lit(1))
    spread_fact = (
        fact.join(F.broadcast(hot), F.col(fact_key).eqNullSafe(F.col(_HOT)), "left")
        .withColumn(_SALT, F.pmod(place, copies.cast("bigint")).cast("int"))
        .drop(_HOT, _COPIES)
    )
    dim_salt = f"{_SALT}_dim"
    repeated = (
        dim.join(F.broadcast(hot), F.col(dim_key).eqNullSafe(F.col(_HOT)), "left")
        .withColumn(dim_salt, F.explode(F.sequence(F.lit(0), copies - 1)))
        .drop(_HOT, _COPIES)
    )
    joined = spread_fact.join(repeated, on & (F.col(_SALT) == F.col(dim_salt)), how)
    return joined.drop(_SALT, dim_salt)


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner",
                spread: Sequence[str] = (), small: bool | None = None, hot: DataFrame | str | None = MEASURE,
                bitmap: DataFrame | str | None = MEASURE) -> DataFrame:
    """Join ``fact`` to ``dim``, whose ``dim_key`` is unique.

    ``how``: inner, left (keep all of ``fact``), left_semi or left_anti. ``spread`` names
    columns of ``fact`` that differ between rows of one key, such as its own key.
    ``small`` is the outcome of the size check and ``hot`` that of ``hot_keys``, where the
    caller knows them already: a key that is unique in ``fact`` too has no hot values (None).
    ``bitmap`` is that of ``key_bitmap``, likewise.
    """
    shared = set(fact.columns) & set(dim.columns)
    if shared:
        raise ValueError(f"both sides have the columns {sorted(shared)}")
    on = F.col(fact_key) == F.col(dim_key)
    if fits_broadcast(dim) if small is None else small:
        return fact.join(F.broadcast(dim), on, how)
    if how in ("left_semi", "left_anti") and isinstance(fact.schema[fact_key].dataType, T.IntegralType):
        bitmap = key_bitmap(dim, dim_key) if isinstance(bitmap, str) else bitmap
        if bitmap is not None:
            return _by_bitmap(fact, bitmap, fact_key, how)
    if isinstance(hot, str):
        hot = hot_keys(fact, fact_key)
    if hot is None:
        return fact.join(dim, on, how)
    return _salted(fact, dim, on, fact_key, dim_key, how, hot, spread)


def lookup_join_keeping(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, keep_fact: bool,
                        spread: Sequence[str] = ()) -> DataFrame:
    """Like ``lookup_join``, but rows of ``dim`` without any match stay, with NULLs.

    ``keep_fact`` also keeps unmatched rows of ``fact`` (a full join). Split into the matched
    part and the unmatched rows of ``dim``, because an outer join can neither broadcast nor
    split the side it preserves; one plain outer join where neither is needed.
    """
    small = fits_broadcast(dim)
    on = F.col(fact_key) == F.col(dim_key)
    if small:
        matched = lookup_join(fact, dim, fact_key, dim_key, "left" if keep_fact else "inner", small=True)
        present = fact.select(fact_key).join(F.broadcast(dim.select(dim_key)), on, "left_semi").distinct()
    else:
        hot = hot_keys(fact, fact_key)
        if hot is None:
            both = fact.join(dim, on, "full" if keep_fact else "right")
            return both
        matched = _salted(fact, dim, on, fact_key, dim_key, "left" if keep_fact else "inner", hot, spread)
        present = fact.select(fact_key).distinct()
    alone = dim.join(present, on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def _distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values other than NULL, written once: they are counted and then joined."""
    values = df.select(F.col(column).alias("_wanted")).filter(F.col("_wanted").isNotNull()).distinct()
    return written(values, "keys")


def _found(table: DataFrame, table_key: str, wanted: DataFrame, key: str) -> DataFrame:
    held = table.select(F.col(table_key).alias(key)).filter(F.col(key).isNotNull())
    if fits_broadcast(wanted):
        return held.join(F.broadcast(wanted), F.col(key) == F.col("_wanted"), "left_semi").distinct()
    if isinstance(held.schema[key].dataType, T.IntegralType) and (bitmap := key_bitmap(wanted, "_wanted")) is not None:
        return _by_bitmap(held, bitmap, key, "left_semi").distinct()
    return held.distinct().join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


def keys_present(table: DataFrame, table_key: str, keys: DataFrame, key: str) -> DataFrame:
    """The distinct values of ``keys.key`` that occur in ``table.table_key``.

    A small key set is sent to the scan of ``table``, so that the large table is filtered
    where it is read and never shuffled.
    """
    return written(_found(table, table_key, _distinct_values(keys, key), key), "present")
