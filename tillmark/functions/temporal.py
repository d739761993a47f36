"""Points in time, cut-offs and month labels. The current time is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = dt.datetime | str | None


def moment(as_of: Moment) -> Column:
    """``as_of`` as a timestamp without zone; ``None`` is the start of the query."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def before(as_of: Moment, *, years: int = 0, months: int = 0) -> Column:
    """``as_of`` minus whole years and months (clamped at the month's end); folds to a literal."""
    return moment(as_of) - F.make_ym_interval(F.lit(years), F.lit(months))


def in_month(column: Column, month: int, year: int) -> Column:
    """True inside one month, as a half-open range that reaches the file scan."""
    first = dt.datetime(year, month, 1)
    following = dt.datetime(year + month // 12, month % 12 + 1, 1)
    return (column >= moment(first)) & (column < moment(following))


def month_start(column: Column) -> Column:
    """First day of the month: a 4-byte grouping key, formatted only after grouping."""
    return F.trunc(column.cast("date"), "month")


def month_label(column: Column) -> Column:
    """``2024-01``."""
    return F.date_format(column, "yyyy-MM")


def month_name(column: Column) -> Column:
    """``January``, without padding."""
    return F.date_format(column, "MMMM")
