"""Text values as typed by a person or found in a file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_text(column: Column, to: T.DataType, strict: bool = True) -> Column:
    """Trimmed text as a value of type ``to``; the word null in any case is NULL.

    Text that does not fit the type raises, or is NULL when ``strict`` is off.
    """
    trimmed = F.trim(column)
    value = F.when(F.lower(trimmed) != "null", trimmed)
    return value.cast(to) if strict else value.try_cast(to)
