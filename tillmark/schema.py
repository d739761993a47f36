"""Tables of the retail database: columns, keys, rules and references.

Keys are 64-bit: order and item numbers outgrow 32 bits at the sizes this is built for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
MONEY, DATE, TIME = T.DecimalType(10, 2), T.DateType(), T.TimestampNTZType()

# The payment methods a payment may name.
PAYMENT_METHODS = ("Cash", "Credit Card", "UPI", "Net Banking")


@dataclass(frozen=True)
class Reference:
    """``column`` must be NULL or a ``parent_key`` of ``parent``."""

    column: str
    parent: str
    parent_key: str
    on_delete: str = "cascade"


@dataclass(frozen=True)
class Table:
    name: str
    columns: T.StructType
    key: str
    unique: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    lengths: tuple[tuple[str, int], ...] = ()
    checks: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    dated: tuple[str, ...] = ()  # columns that default to the time of the insert

    def with_reference(self, reference: Reference) -> "Table":
        """Drop the reference on the same column, if any, and add this one."""
        kept = tuple(r for r in self.references if r.column != reference.column)
        return Table(self.name, self.columns, self.key, self.unique, self.required, self.lengths,
                     self.checks, kept + (reference,), self.dated)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


# Names, lengths, rules and references that stored data must meet.
TABLES: dict[str, Table] = {
    table.name: table
    for table in (
        Table(
            "stores",
            _columns(store_id=LONG, name=TEXT, location=TEXT, manager_id=LONG),
            key="store_id",
            unique=("name",),
            required=("name", "location"),
            lengths=(("name", 255), ("location", 255)),
        ),
        Table(
            "employees",
            _columns(employee_id=LONG, name=TEXT, role=TEXT, store_id=LONG, salary=MONEY, manager_id=LONG),
            key="employee_id",
            required=("name", "role"),
            lengths=(("name", 255), ("role", 100)),
            checks=("salary > 0",),
            references=(
                Reference("store_id", "stores", "store_id"),
                Reference("manager_id", "employees", "employee_id", on_delete="set null"),
            ),
        ),
        Table(
            "customers",
            _columns(customer_id=LONG, name=TEXT, email=TEXT, phone=TEXT, city=TEXT),
            key="customer_id",
            unique=("email", "phone"),
            required=("name", "email", "phone", "city"),
            lengths=(("name", 255), ("email", 255), ("phone", 15), ("city", 100)),
            checks=("email LIKE '%@%.%'",),
        ),
        Table(
            "suppliers",
            _columns(supplier_id=LONG, name=TEXT, contact_person=TEXT, phone=TEXT, city=TEXT),
            key="supplier_id",
            unique=("phone",),
            required=("name", "contact_person", "phone", "city"),
            lengths=(("name", 255), ("contact_person", 255), ("phone", 15), ("city", 100)),
        ),
        Table(
            "products",
            _columns(product_id=LONG, name=TEXT, category=TEXT, price=MONEY, stock=INT, supplier_id=LONG),
            key="product_id",
            required=("name", "category"),
            lengths=(("name", 255), ("category", 100)),
            checks=("price > 0", "stock >= 0"),
            references=(Reference("supplier_id", "suppliers", "supplier_id"),),
        ),
        Table(
            "orders",
            _columns(order_id=LONG, customer_id=LONG, store_id=LONG, order_date=TIME, total_amount=MONEY),
            key="order_id",
            checks=("total_amount >= 0",),
            references=(
                Reference("customer_id", "customers", "customer_id"),
                Reference("store_id", "stores", "store_id"),
            ),
            dated=("order_date",),
        ),
        Table(
            "order_items",
            _columns(order_item_id=LONG, order_id=LONG, product_id=LONG, quantity=INT, price=MONEY),
            key="order_item_id",
            checks=("quantity > 0", "price > 0"),
            references=(
                Reference("order_id", "orders", "order_id"),
                Reference("product_id", "products", "product_id"),
            ),
        ),
        Table(
            "payments",
            _columns(payment_id=LONG, order_id=LONG, amount=MONEY, payment_method=TEXT, payment_date=TIME),
            key="payment_id",
            lengths=(("payment_method", 50),),
            checks=("amount > 0", "payment_method IN ('" + "', '".join(PAYMENT_METHODS) + "')"),
            references=(Reference("order_id", "orders", "order_id"),),
            dated=("payment_date",),
        ),
        Table(
            "employee_audit",
            _columns(audit_id=LONG, employee_id=LONG, name=TEXT, role=TEXT, store_id=LONG, salary=MONEY,
                     deleted_at=TIME),
            key="audit_id",
            lengths=(("name", 255), ("role", 100)),
            dated=("deleted_at",),
        ),
    )
}

# Session-scoped delivery list of new stock levels.
SHIPMENTS = _columns(product_id=LONG, new_stock=INT)

# Daily sales lines of the monthly report.
SALES = _columns(Date=TEXT, Product=TEXT, Revenue=LONG)
