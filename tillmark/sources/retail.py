"""The retail tables as views of the Parquet star schema in a folder.

Keys keep their 64-bit type, so that filters and joins on them reach the file scan as they are.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.money import money
from tillmark.schema import PAYMENT_METHODS


# Columns of the star schema; naming them saves a look into the files before every query.
STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def _phone(key: str, width: int = 15):
    return F.lpad(F.col(key).cast("string"), width, "0")


class Retail:
    """Lazily read retail tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMA[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def stores(self) -> DataFrame:
        places = self.raw("region").select(F.col("r_regionkey"), F.col("r_name").alias("location"))
        shops = self.raw("nation")
        return shops.join(places, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("store_id"), F.col("n_name").alias("name"), "location",
            F.lit(None).cast("bigint").alias("manager_id"))

    @cached_property
    def employees(self) -> DataFrame:
        key = F.col("s_suppkey")
        role = F.when(key < 3, "Manager").when(key % 2 == 0, "Cashier").otherwise("Sales Associate")
        return self.raw("supplier").select(
            (key + 1).alias("employee_id"), F.col("s_name").alias("name"), role.alias("role"),
            F.col("s_nationkey").cast("bigint").alias("store_id"),
            money(30000 + key % 97 * 100).alias("salary"),
            F.when(key >= 3, F.floor(key / 3)).cast("bigint").alias("manager_id"))

    @cached_property
    def customers(self) -> DataFrame:
        address = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), address.alias("email"),
            _phone("c_custkey").alias("phone"), F.col("c_mktsegment").alias("city"))

    @cached_property
    def suppliers(self) -> DataFrame:
        towns = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        return self.raw("supplier").join(towns, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
            F.col("s_name").alias("contact_person"), _phone("s_suppkey").alias("phone"), "city")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), money(F.col("p_retailprice")).alias("price"),
            F.col("p_size").alias("stock"), (F.col("p_partkey") % 10).alias("supplier_id"))

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % 25).alias("store_id"), F.col("o_orderdate").alias("order_date"),
            money(F.col("o_totalprice")).alias("total_amount"))

    @cached_property
    def order_items(self) -> DataFrame:
        """``(order_id, line_no)`` is not unique in this data."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
            money(F.col("l_extendedprice")).alias("price"))

    @cached_property
    def payments(self) -> DataFrame:
        names = F.array(*[F.lit(name) for name in PAYMENT_METHODS])
        method = F.get(names, (F.col("o_orderkey") % len(PAYMENT_METHODS)).cast("int"))
        return self.raw("orders").select(
            F.col("o_orderkey").alias("payment_id"), F.col("o_orderkey").alias("order_id"),
            money(F.col("o_totalprice")).alias("amount"), method.alias("payment_method"),
            F.col("o_orderdate").alias("payment_date"))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "stores", "employees", "customers", "suppliers", "products", "orders", "order_items", "payments")}

    def register_views(self, prefix: str = "") -> list[str]:
        """Register every table as a temporary view and return the names."""
        tables = self.tables()
        for name, df in tables.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + name for name in tables]

    # ---- deliveries that break rules: all rows, with values changed by the data itself ----

    @cached_property
    def unchecked_customers(self) -> DataFrame:
        """All customers; each market segment breaks another rule, AUTOMOBILE none."""
        segment = F.col("c_mktsegment")
        plain = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
        address = (F.when((segment == "MACHINERY") & (F.col("c_custkey") % 3 == 0), F.concat(plain, F.lit("@localhost")))
                   .when(segment == "MACHINERY", plain).otherwise(F.concat(plain, F.lit("@example.com"))))
        phone = (F.when(segment == "FURNITURE", _phone("c_custkey", 20))
                 .when(segment == "BUILDING", F.col("c_nationkey").cast("string"))
                 .otherwise(_phone("c_custkey")))
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.when(segment != "HOUSEHOLD", F.col("c_name")).alias("name"),
            address.alias("email"), phone.alias("phone"), segment.alias("city"))

    @cached_property
    def unchecked_orders(self) -> DataFrame:
        """All orders: pending ones name no customer and no date, open ones an unknown customer."""
        status = F.col("o_orderstatus")
        customer = F.when(status == "F", F.col("o_custkey")).when(status == "O", -1 - F.col("o_custkey"))
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), customer.alias("customer_id"),
            (F.col("o_orderkey") % 25).alias("store_id"), F.when(status != "P", F.col("o_orderdate")).alias("order_date"),
            money(F.col("o_totalprice")).alias("total_amount"))

    @cached_property
    def unchecked_items(self) -> DataFrame:
        """All order items: small quantities fall to 0 or below, returned items name no product."""
        product = F.when(F.col("l_returnflag") == "R", -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            product.alias("product_id"), (F.col("l_quantity") - 5).cast("int").alias("quantity"),
            money(F.col("l_extendedprice")).alias("price"))
