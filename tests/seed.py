"""A small shop; expected results are worked out from these rows by plain Python in the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillmark.schema import TABLES

STORES = [(n, f"Shop {n}", f"Town {n}", 2 * n - 1) for n in range(1, 6)]
# A manager and an assistant per store.
EMPLOYEES = [
    (n, f"Employee {n}", "Manager" if n % 2 else "Assistant", (n + 1) // 2, Decimal(30_000 + 1_250 * n), None if n % 2 else n - 1)
    for n in range(1, 11)]
CUSTOMERS = [(n, f"Customer {n}", f"c{n}@example.com", f"{n:010d}", f"Town {n % 10}") for n in range(1, 21)]
SUPPLIERS = [(n, f"Supplier {n}", f"Contact {n}", f"{n:010d}", "Town") for n in range(1, 11)]
PRODUCTS = [
    (1, "Kettle", "Kitchen", Decimal("24.90"), 50, 1), (2, "Desk lamp", "Electronics", Decimal("59.00"), 100, 1),
    (3, "Radio", "Electronics", Decimal("35.25"), 200, 2), (4, "Bookcase", "Furniture", Decimal("149.00"), 20, 2),
    *[(n, f"Product {n}", "Other", Decimal("10.00"), 100, n % 10 + 1) for n in range(5, 17)]]
# Customer n has the orders n, n + 20, n + 40, ... four days apart each.
ORDERS = [
    (n, (n - 1) % 20 + 1, n * 3 % 5 + 1, dt.datetime(2024, 1, 1) + dt.timedelta(days=4 * n), Decimal(50 + n * 37 % 450))
    for n in range(1, 101)]
ITEMS = [(1, 1, 2, 3, Decimal("59.00")), (2, 2, 3, 4, Decimal("35.25")), (3, 3, 4, 6, Decimal("149.00"))]


def shop(spark):
    """The tables as DataFrames by name."""
    rows = {"stores": STORES, "employees": EMPLOYEES, "customers": CUSTOMERS, "suppliers": SUPPLIERS, "products": PRODUCTS,
            "orders": ORDERS, "order_items": ITEMS, "payments": [], "employee_audit": []}
    return {name: spark.createDataFrame(values, TABLES[name].columns) for name, values in rows.items()}
