"""Filters, joins, set operations and sorted listings over the retail tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.ordering import falling, rising
from tillmark.functions.temporal import Moment, before, in_month
from tillmark.operators.keyed import lookup_join, lookup_join_keeping

CUSTOMER_ORDER = ("customer_id", "name", "order_id", "order_date", "total_amount")


# ---- filters ---------------------------------------------------------------------------


def matching(df: DataFrame, column: str, pattern: str, ignore_case: bool = False) -> DataFrame:
    """Rows whose text matches a LIKE pattern."""
    text = F.col(column)
    return df.filter(text.ilike(pattern) if ignore_case else text.like(pattern))


def orders_of(orders: DataFrame, customer_id: int) -> DataFrame:
    """Orders of one customer, newest first."""
    return orders.filter(F.col("customer_id") == customer_id).orderBy(falling("order_date"), "order_id")


def without_manager(employees: DataFrame) -> DataFrame:
    return employees.filter(F.col("manager_id").isNull())


def undated_or_before(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column) < cutoff))


def since(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    return df.filter(F.col(column) >= cutoff)


def of_month(df: DataFrame, column: str, month: int, year: int) -> DataFrame:
    return df.filter(in_month(F.col(column), month, year))


def having_value(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers for whom an order exists."""
    buyers = orders.select(F.col("customer_id").alias("_buyer")).distinct()
    return customers.join(buyers, F.col("customer_id") == F.col("_buyer"), "left_semi")


def order_history(orders: DataFrame, as_of: Moment, years: int) -> DataFrame:
    """Per customer with orders, whether any order is undated or older than ``years``.

    One row per customer: grouped on the map side first, so a customer with very many
    orders costs no more than another one.
    """
    old = F.col("order_date").isNull() | (F.col("order_date") < before(as_of, years=years))
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy(F.col("customer_id").alias("_buyer"))
        .agg(F.bool_or(old).alias("_has_old"))
    )


def stale_customers(customers: DataFrame, orders: DataFrame, as_of: Moment, years: int = 2) -> DataFrame:
    """Customers with no order, or with any order that is undated or older than ``years``."""
    history = order_history(orders, as_of, years)
    active = history.filter(~F.col("_has_old"))
    return customers.join(active, F.col("customer_id") == F.col("_buyer"), "left_anti")


def active_customers(customers: DataFrame, orders: DataFrame, as_of: Moment, years: int = 2) -> DataFrame:
    """Customers that are not stale: they have orders, all of them dated and recent enough."""
    active = order_history(orders, as_of, years).filter(~F.col("_has_old"))
    return customers.join(active, F.col("customer_id") == F.col("_buyer"), "left_semi")


def stock_of_items(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Every order item with the stock of its product, NULL when the product is unknown."""
    levels = products.select(F.col("product_id").alias("_product"), "stock")
    spread = [c for c in ("order_item_id", "order_id", "line_no") if c in order_items.columns]
    return lookup_join(order_items, levels, "product_id", "_product", "left", spread).drop("_product")


# ---- joins -----------------------------------------------------------------------------


def _named(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "name")


def _bought(orders: DataFrame, *extra: str) -> DataFrame:
    columns = ("order_id", *extra, "order_date", "total_amount")
    return orders.select(F.col("customer_id").alias("order_customer_id"), *columns)


def customer_orders_inner(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their orders, newest first."""
    joined = lookup_join(_bought(orders), _named(customers), "order_customer_id", "customer_id", "inner", ["order_id"])
    return joined.select(*CUSTOMER_ORDER).orderBy(falling("order_date"), "order_id")


def customer_orders_left(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers with their orders, or NULLs."""
    joined = lookup_join_keeping(_bought(orders), _named(customers), "order_customer_id", "customer_id",
                                 keep_fact=False, spread=["order_id"])
    return joined.select(*CUSTOMER_ORDER).orderBy(rising("customer_id"), "order_id")


def customer_orders_right(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All orders, newest first; the customer's columns are NULL when there is no such customer."""
    joined = lookup_join(_bought(orders), _named(customers), "order_customer_id", "customer_id", "left", ["order_id"])
    return joined.select(*CUSTOMER_ORDER).orderBy(falling("order_date"), "order_id")


def customer_orders_full(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers and all orders, orders without a customer last."""
    joined = lookup_join_keeping(_bought(orders), _named(customers), "order_customer_id", "customer_id",
                                 keep_fact=True, spread=["order_id"])
    return joined.select(*CUSTOMER_ORDER).orderBy(rising("customer_id"), "order_id")


def customers_orders_wide(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All columns of both tables for all customers; the order's key is ``order_customer_id``."""
    joined = lookup_join_keeping(_bought(orders, "store_id"), customers, "order_customer_id", "customer_id",
                                 keep_fact=False, spread=["order_id"])
    return joined.select(*customers.columns, "order_id", "order_customer_id", "store_id", "order_date",
                         "total_amount")


def stale_preview(customers: DataFrame, orders: DataFrame, as_of: Moment, years: int = 2) -> DataFrame:
    """The rows that make a customer stale: each old or undated order, or the missing order.

    Old orders are filtered at the scan. Customers without any order join the result as the
    rows that find no order at all, old or not.
    """
    old = undated_or_before(_bought(orders, "store_id"), "order_date", before(as_of, years=years))
    columns = [*customers.columns, "order_id", "order_customer_id", "store_id", "order_date", "total_amount"]
    matched = lookup_join(old, customers, "order_customer_id", "customer_id", "inner", ["order_id"])
    buyers = orders.select(F.col("customer_id").alias("_buyer")).distinct()
    without = customers.join(buyers, F.col("customer_id") == F.col("_buyer"), "left_anti")
    return matched.select(*columns).unionByName(without, allowMissingColumns=True)


def employee_managers(employees: DataFrame) -> DataFrame:
    """Each employee with the manager's key and name, NULLs at the top level."""
    staff = employees.select(F.col("employee_id").alias("emp_id"), F.col("name").alias("employee_name"),
                             F.col("manager_id").alias("_reports_to"))
    managers = employees.select(F.col("employee_id").alias("manager_id"), F.col("name").alias("manager_name"))
    joined = lookup_join(staff, managers, "_reports_to", "manager_id", "left", ["emp_id"])
    return joined.drop("_reports_to").orderBy(rising("manager_id"), "emp_id")


def orders_with_store(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Orders with the name of their store; orders without a known store are left out."""
    shops = stores.select(F.col("store_id").alias("_store"), F.col("name").alias("store_name"))
    joined = lookup_join(orders, shops, "store_id", "_store", "inner", ["order_id"])
    return joined.select("order_id", "store_id", "store_name", "order_date", "total_amount")


# ---- set operations --------------------------------------------------------------------


def people(customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Customers and employees in one list without duplicates, by type and name."""
    buyers = customers.select(F.col("customer_id").alias("id"), "name", "email", F.lit("Customer").alias("type"))
    staff = employees.select(F.col("employee_id").alias("id"), "name", F.lit(None).cast("string").alias("email"),
                             F.lit("Employee").alias("type"))
    return buyers.unionByName(staff).distinct().orderBy(rising("type"), rising("name"), "id", "email")


def orders_by_activity(orders: DataFrame, as_of: Moment, months: int = 6) -> DataFrame:
    """Orders tagged Active or Inactive by age, newest first; undated orders are in neither.

    The two branches of the union exclude each other, so one scan and a CASE give the same rows.
    """
    recent = F.col("order_date") >= before(as_of, months=months)
    return (
        orders.filter(F.col("order_date").isNotNull())
        .select("order_id", "customer_id", "store_id", "order_date", "total_amount",
                F.when(recent, "Active").otherwise("Inactive").alias("status"))
        .orderBy(falling("order_date"), "order_id")
    )
