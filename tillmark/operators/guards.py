"""The stock guard on new order items and the audit of deleted employees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.temporal import Moment, moment
from tillmark.operators.constraints import ARRIVAL, RuleBroken, with_arrival
from tillmark.operators.relational import stock_of_items


def is_short() -> Column:
    """The stock is known to be below the quantity; NULL on either side is not."""
    return F.coalesce(F.col("stock") < F.col("quantity"), F.lit(False))


def out_of_stock_items(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Items that ask for more than the product's stock, with that ``stock``."""
    return stock_of_items(order_items, products).filter(is_short())


def in_stock_items(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Items that pass the guard. Each is judged alone against the same stock, which does not
    go down; an unknown product, or a NULL stock or quantity, passes."""
    return stock_of_items(order_items, products).filter(~is_short()).select(*order_items.columns)


def guard_stock(order_items: DataFrame, products: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) items; in mode ``fail`` one rejected item refuses all."""
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    accepted, rejected = guard_arrivals(order_items, products)
    if mode == "fail" and not rejected.isEmpty():
        raise RuleBroken("cannot place order: out of stock")
    return accepted.select(*order_items.columns), rejected


def guard_arrivals(order_items: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) items; the accepted ones, a written table, keep their place of arrival."""
    judged = with_arrival(stock_of_items(order_items, products), "guarded")  # looked up once, used twice
    return judged.filter(~is_short()).drop("stock"), judged.filter(is_short()).drop(ARRIVAL)


def audit_rows(deleted: DataFrame, as_of: Moment) -> DataFrame:
    """What the audit keeps of deleted employees; the key is assigned when it is appended."""
    return deleted.select("employee_id", "name", "role", "store_id", "salary", moment(as_of).alias("deleted_at"))
