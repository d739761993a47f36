"""Stored tables and their versions, and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.operators.reports import store_revenue, top_selling_products
from tillmark.schema import TABLES


def create_table(spark: SparkSession, name: str, base: str) -> DataFrame:
    """An empty typed table at ``base/name``, unless there is one; registered as a view."""
    path = f"{base}/{name}"
    schema = TABLES[name].columns
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.createOrReplaceTempView(name)
    return table


def create_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: create_table(spark, name, base) for name in TABLES}


def create_view(df: DataFrame, name: str) -> None:
    """Name a query for the session, replacing an older one of that name."""
    df.createOrReplaceTempView(name)


def create_report_views(spark: SparkSession, prefix: str = "") -> None:
    """The views ``top_selling_products`` and ``store_revenue`` over the registered tables."""
    table = lambda name: spark.table(prefix + name)
    best = top_selling_products(table("order_items"), table("products"))
    create_view(best, prefix + "top_selling_products")
    create_view(store_revenue(table("orders"), table("stores")), prefix + "store_revenue")


def create_report_functions(spark: SparkSession, prefix: str = "") -> None:
    """SQL table functions over the registered orders: ``customer_orders(id)`` and
    ``sales_report(month, year)``. They are inlined, so their conditions reach the scan."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}customer_orders(wanted BIGINT)
        RETURNS TABLE (order_id BIGINT, store_id BIGINT, order_date TIMESTAMP_NTZ, total_amount DECIMAL(10,2))
        RETURN SELECT o.order_id, o.store_id, o.order_date, o.total_amount FROM {prefix}orders AS o
               WHERE o.customer_id = wanted""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}sales_report(in_month INT, in_year INT)
        RETURNS TABLE (store_id BIGINT, total_sales DECIMAL(20,2))
        RETURN SELECT o.store_id, CAST(sum(o.total_amount) AS DECIMAL(20,2)) FROM {prefix}orders AS o
               WHERE o.order_date >= CAST(make_date(in_year, in_month, 1) AS TIMESTAMP_NTZ)
                 AND o.order_date < CAST(add_months(make_date(in_year, in_month, 1), 1) AS TIMESTAMP_NTZ)
               GROUP BY o.store_id""")


def publish(state: DataFrame, name: str, base: str, version: str) -> DataFrame:
    """Write the new state of a table as ``base/name/version=...`` and point its view there.

    A version that exists is an error; readers of older versions are not disturbed.
    """
    path = f"{base}/{name}/version={version}"
    state.write.mode("errorifexists").parquet(path)
    stored = state.sparkSession.read.schema(state.schema).parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
