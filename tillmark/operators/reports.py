"""Reports: sums per product, store, month and customer.

Each report sums the large table by its key first. Spark combines on the map side, so the
shuffle carries one row per key and task however many rows a key has, and the names are
joined to the sums, where the key is unique on both sides.
"""

from __future__ import annotations

import calendar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.money import total
from tillmark.functions.ordering import falling, rising
from tillmark.functions.temporal import month_label, month_name, month_start
from tillmark.operators.keyed import lookup_join
from tillmark.operators.relational import of_month, orders_of

# Column names of the two month pivots, as the reports spell them.
MONTH_COLUMNS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
QUARTER_COLUMNS = ("january", "febrauary", "march", "april")


def top_selling_products(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Units sold per product, best seller first."""
    sold = order_items.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("total_sold"))
    names = products.select(F.col("product_id").alias("_product"), F.col("name").alias("product_name"))
    return (
        sold.join(names, F.col("product_id") == F.col("_product"))
        .select("product_id", "product_name", "total_sold")
        .orderBy(falling("total_sold"), "product_id")
    )


def top_products(order_items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best sellers."""
    return top_selling_products(order_items, products).limit(n)


def store_revenue(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per store, highest first; stores without orders are absent."""
    sums = orders.groupBy("store_id").agg(total(F.col("total_amount")).alias("total_revenue"))
    names = stores.select(F.col("store_id").alias("_store"), F.col("name").alias("store_name"))
    return (
        sums.join(names, F.col("store_id") == F.col("_store"))
        .select("store_id", "store_name", "total_revenue")
        .orderBy(falling("total_revenue"), "store_id")
    )


def customer_total_spending(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Spending per customer with orders, highest first."""
    sums = orders.groupBy(F.col("customer_id").alias("_buyer")).agg(
        total(F.col("total_amount")).alias("total_spending"))
    return (
        customers.select("customer_id", "name")
        .join(sums, F.col("customer_id") == F.col("_buyer"))
        .select("customer_id", "name", "total_spending")
        .orderBy(falling("total_spending"), "customer_id")
    )


def monthly_revenue_per_store(orders: DataFrame) -> DataFrame:
    """Revenue per store and calendar month (``YYYY-MM``)."""
    return (
        orders.groupBy("store_id", month_start(F.col("order_date")).alias("_first"))
        .agg(total(F.col("total_amount")).alias("total_revenue"))
        .select("store_id", month_label(F.col("_first")).alias("month"), "total_revenue")
        .orderBy(rising("store_id"), rising("month"))
    )


def _by_month_of_year(orders: DataFrame) -> DataFrame:
    """Sum per store and month number, all years together: at most 13 rows per store."""
    return orders.groupBy("store_id", F.month("order_date").alias("_month")).agg(
        total(F.col("total_amount")).alias("_amount"))


def pivot_months_manual(orders: DataFrame) -> DataFrame:
    """One column per month of the year, 0 where a store sold nothing."""
    cells = [
        total(F.when(F.col("_month") == number, F.col("_amount")).otherwise(0)).alias(name)
        for number, name in enumerate(MONTH_COLUMNS, 1)
    ]
    return _by_month_of_year(orders).groupBy("store_id").agg(*cells).orderBy(rising("store_id"))


def pivot_months_crosstab(orders: DataFrame) -> DataFrame:
    """January to April, NULL where a store sold nothing; other months give no column."""
    months = [calendar.month_name[n] for n in range(1, len(QUARTER_COLUMNS) + 1)]
    by_name = _by_month_of_year(orders).withColumn(
        "_name", month_name(F.make_date(F.lit(2000), F.col("_month"), F.lit(1))))
    wide = by_name.groupBy("store_id").pivot("_name", months).agg(total(F.col("_amount")))
    named = [F.col(month).alias(name) for month, name in zip(months, QUARTER_COLUMNS)]
    return wide.select("store_id", *named).orderBy(rising("store_id"))


def sales_report(orders: DataFrame, month: int, year: int) -> DataFrame:
    """Sales per store in one month; the month reaches the file scan as a date range."""
    return (
        of_month(orders, "order_date", month, year)
        .groupBy("store_id")
        .agg(total(F.col("total_amount")).alias("total_sales"))
    )


def customer_orders(orders: DataFrame, customer_id: int) -> DataFrame:
    """Orders of one customer without the customer's key."""
    return orders_of(orders, customer_id).select("order_id", "store_id", "order_date", "total_amount")


def daily_product_sales(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines ``Date``, ``Product``, ``Revenue`` (whole currency units) of the monthly report.

    Items meet the date of their order, and are summed per date and product before they meet
    the product's name.
    """
    days = orders.select(F.col("order_id").alias("_order"), F.col("order_date").cast("date").alias("_day"))
    lines = order_items.select("order_id", "product_id", "price")
    per_day = (
        lookup_join(lines, days, "order_id", "_order", "inner", ["product_id", "price"])
        .groupBy("_day", "product_id")
        .agg(total(F.col("price")).alias("_amount"))
    )
    names = products.select(F.col("product_id").alias("_product"), F.col("name").alias("Product"))
    return (
        per_day.join(names, F.col("product_id") == F.col("_product"))
        .groupBy(F.date_format("_day", "yyyy-MM-dd").alias("Date"), "Product")
        .agg(F.floor(F.sum("_amount")).cast("bigint").alias("Revenue"))
    )
