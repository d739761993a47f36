"""Samples of bounded size by a hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sampled(key: Column, rows: int, max_rows: int) -> Column:
    """True for a share of ``max_rows / rows`` of the keys, by a 63-bit hash: fine enough for any number of rows."""
    most = (1 << 63) - 1
    return F.xxhash64(key).bitwiseAND(F.lit(most)) <= F.lit(most if rows <= max_rows else most * max_rows // rows)
