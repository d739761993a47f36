"""Stored tables, queries with bound values, literal rows and the catalog."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a Parquet table; a known schema saves the look into a file footer."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def query_to_frame(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a SELECT over the registered views; values are bound to ``:name``, never pasted in."""
    return spark.sql(query, args=dict(args or {}))


def fetch_rows(df: DataFrame) -> Iterator[Row]:
    """All rows for the client, one partition in memory at a time."""
    return df.toLocalIterator()


def rows_to_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]],
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Dictionaries as a frame; types are inferred when no schema is given."""
    return spark.createDataFrame([dict(row) for row in rows], schema)


def values_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence[Any]]) -> DataFrame:
    """Literal rows by position, missing trailing columns are an error."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views of the current schema."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("table_name"))


def list_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names in order; empty when there is no such table."""
    return spark.table(table).columns if spark.catalog.tableExists(table) else []


def count_rows(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``table_name`` and ``n_rows`` of the named tables."""
    counts = None
    for name in names:
        one = spark.table(name).select(F.lit(name).alias("table_name"))
        counts = one if counts is None else counts.unionByName(one)
    return counts.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))


def count_values(spark: SparkSession, name: str) -> DataFrame:
    """``table_name``, ``column_name``, its place, and how many rows hold a value, in one pass."""
    columns = list_columns(spark, name)
    counts = spark.table(name).agg(*[F.count(c).alias(c) for c in columns])
    listed = [
        F.struct(F.lit(c).alias("column_name"), F.lit(place).alias("place"), F.col(c).alias("n_values"))
        for place, c in enumerate(columns, 1)
    ]
    return counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*listed)))
