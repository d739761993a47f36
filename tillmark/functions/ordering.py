"""Sort order of NULLs as in PostgreSQL: first when descending, last when ascending.

Every report sort ends in a unique column, so that a global sort can split a value
that fills a large part of the table over several range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rising(name: str) -> Column:
    return F.asc_nulls_last(name)


def falling(name: str) -> Column:
    return F.desc_nulls_first(name)
