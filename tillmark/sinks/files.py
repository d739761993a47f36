"""Exports. Each is a folder of part files written by the executors; nothing passes the driver.

A sorted frame keeps its order over the part numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; quotes are doubled, NULL is empty and an empty text is ``""``.

    Texts are written as they are, blanks and line breaks included.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def chosen_columns(df: DataFrame, columns: str) -> DataFrame:
    """``a,b`` or ``*``; a name the table lacks is an error."""
    if columns.strip() == "*":
        return df
    names = [name.strip() for name in columns.split(",")]
    unknown = [name for name in names if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.select(*[F.col(f"`{name}`") for name in names])


def export_columns_csv(df: DataFrame, columns: str, path: str) -> str:
    return export_csv(chosen_columns(df, columns), path)


def export_report(df: DataFrame, path: str, order_by: Sequence[Column] = ()) -> tuple[str, str]:
    """The report as Parquet and as CSV; it is computed once, the CSV is made from the Parquet,
    sorted by ``order_by``."""
    parquet, csv = f"{path}/parquet", f"{path}/csv"
    df.write.mode("overwrite").parquet(parquet)
    stored = df.sparkSession.read.schema(df.schema).parquet(parquet)
    export_csv(stored.orderBy(*order_by) if order_by else stored, csv)
    return parquet, csv


def export_monthly(df: DataFrame, base: str, month: str) -> str:
    """Write one month's report as the partition ``report_month`` of ``base``; a rerun replaces
    that month only. Returns the partition's path."""
    (
        df.withColumn("report_month", F.lit(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_month")
        .parquet(base)
    )
    return f"{base}/report_month={month}"


def export_clustered(df: DataFrame, path: str, range_by: Sequence[str], tie: Sequence[str] = (),
                     files: int | None = None) -> str:
    """Write ``df`` in ranges of ``range_by``, sorted inside each file, so that lookups on these
    columns skip files and row groups by their min and max.

    ``tie`` adds columns that split one large key over several ranges.
    """
    by = [*range_by, *tie]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path
