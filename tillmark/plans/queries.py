"""Every query by name: a function of the session and the folder with the Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.money import total
from tillmark.functions.ordering import falling, rising
from tillmark.functions.temporal import before
from tillmark.operators import constraints, guards, hierarchy, relational, reports, writes
from tillmark.plans.measure import timed_queries
from tillmark.schema import PAYMENT_METHODS, TABLES, Reference
from tillmark.session import scratch_path
from tillmark.sinks import files, jobs
from tillmark.sinks.tables import create_report_functions, create_report_views, create_table
from tillmark.sinks.versions import publish_changes, publish_whole
from tillmark.sources import csv, tables
from tillmark.sources.retail import Retail
from tillmark.streaming.stock import guard_arriving_items

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Times of the statements that compare with the current time.
TODAY = "2001-08-01"  # recent orders
STALE_DAY = "1997-02-01"  # customers with orders older than two years
PAYDAY = "2000-06-01"  # raises after five years


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Register a query over the retail tables under the name of its function."""
    QUERIES[build.__name__] = lambda spark, folder: build(Retail(spark, folder))
    return build


def _scratch(r: Retail, label: str) -> str:
    return scratch_path(r.spark, label)


def awkward(key: str, name: str) -> Column:
    """Texts that a file must carry unchanged: padded, empty, quoted and of several lines."""
    text, kind = F.col(name), F.col(key) % 5
    return (F.when(kind == 0, F.concat(F.lit("  "), text, F.lit(" "))).when(kind == 1, "")
            .when(kind == 2, F.concat(F.lit('say "'), text, F.lit('", ok'))).when(kind == 3, F.concat(F.lit("one\n"), text))
            .otherwise(text))


# ---- sources ---------------------------------------------------------------------------


@query
def scan_table(r: Retail) -> DataFrame:
    return r.products


@query
def scan_csv(r: Retail) -> DataFrame:
    path = files.export_csv(r.customers, _scratch(r, "customers"))
    return csv.scan_csv(r.spark, path, r.customers.schema)


@query
def query_to_frame(r: Retail) -> DataFrame:
    r.register_views("retail_")
    text = """SELECT customer_id, count(*) AS n_orders, CAST(sum(total_amount) AS DECIMAL(20,2)) AS spent
              FROM retail_orders WHERE total_amount >= :least AND order_date >= CAST(:since AS TIMESTAMP_NTZ)
              GROUP BY customer_id"""
    return tables.query_to_frame(r.spark, text, {"least": 100000, "since": "1999-01-01"})


@query
def fetch_rows(r: Retail) -> DataFrame:
    revenue = reports.store_revenue(r.orders, r.stores)
    return tables.values_rows(r.spark, revenue.schema, tables.fetch_rows(revenue))


@query
def rows_to_frame(r: Retail) -> DataFrame:
    monthly = r.orders.groupBy(F.month("order_date").alias("month")).agg(F.count(F.lit(1)).alias("n_orders"))
    rows = [row.asDict() for row in tables.fetch_rows(monthly)]
    return tables.rows_to_frame(r.spark, rows, "month int, n_orders bigint")


@query
def values_rows(r: Retail) -> DataFrame:
    listed = tables.values_rows(r.spark, "payment_method string", [(m,) for m in (*PAYMENT_METHODS, "Cheque")])
    used = r.payments.groupBy(F.col("payment_method").alias("_method")).agg(total(F.col("amount")).alias("paid"))
    return listed.join(used, F.col("payment_method") == F.col("_method"), "left").drop("_method")


@query
def temp_table(r: Retail) -> DataFrame:
    path = files.export_csv(_shipments(r), _scratch(r, "shipments"))
    return csv.shipments_table(r.spark, path, "retail_temp_shipments")


@query
def list_tables(r: Retail) -> DataFrame:
    """The tables of the shop that the catalog lists, with their sizes."""
    registered = r.register_views("retail_")
    found = tables.list_tables(r.spark).filter(F.col("table_name").isin(registered))
    sizes = tables.count_rows(r.spark, registered).withColumnRenamed("table_name", "_name")
    return found.join(sizes, F.col("table_name") == F.col("_name")).drop("_name")


@query
def list_columns(r: Retail) -> DataFrame:
    """The columns of every table of the shop, with the number of rows that hold a value."""
    found = None
    for name in r.register_views("retail_"):
        one = tables.count_values(r.spark, name)
        found = one if found is None else found.unionByName(one)
    return found


def _shipments(r: Retail) -> DataFrame:
    """New stock for every ordered product: the largest quantity ordered at once."""
    return r.order_items.groupBy("product_id").agg(F.max("quantity").alias("new_stock"))


# ---- sinks -----------------------------------------------------------------------------


@query
def export_csv(r: Retail) -> DataFrame:
    best = reports.top_selling_products(r.order_items, r.products).withColumn(
        "product_name", awkward("product_id", "product_name"))
    return csv.scan_csv(r.spark, files.export_csv(best, _scratch(r, "export")), best.schema, line_breaks=True)


@query
def export_columns_csv(r: Retail) -> DataFrame:
    wanted = "product_id, name, stock"
    goods = r.products.withColumn("name", awkward("product_id", "name"))
    path = files.export_columns_csv(goods, wanted, _scratch(r, "export"))
    return csv.scan_csv(r.spark, path, files.chosen_columns(goods, wanted).schema, line_breaks=True)


@query
def export_report(r: Retail) -> DataFrame:
    monthly = reports.monthly_revenue_per_store(r.orders)
    by = [rising("store_id"), rising("month")]
    parquet, path = files.export_report(monthly, _scratch(r, "report"), by)
    both = csv.scan_csv(r.spark, path, monthly.schema).select("*", F.lit("csv").alias("format"))
    return both.unionByName(r.spark.read.parquet(parquet).select("*", F.lit("parquet").alias("format")))


@query
def copy_query_csv(r: Retail) -> DataFrame:
    spending = reports.customer_total_spending(r.customers, r.orders).withColumn("name", awkward("customer_id", "name"))
    return csv.scan_csv(r.spark, files.export_csv(spending, _scratch(r, "copy")), spending.schema, line_breaks=True)


@query
def copy_table_csv(r: Retail) -> DataFrame:
    staff = r.employees.withColumn("name", awkward("employee_id", "name"))
    return csv.scan_csv(r.spark, files.export_csv(staff, _scratch(r, "copy")), staff.schema, line_breaks=True)


@query
def sales_report_job(r: Retail) -> DataFrame:
    sales = reports.daily_product_sales(r.order_items, r.orders, r.products)
    path = jobs.sales_report_job(sales, _scratch(r, "reports"), dt.date.fromisoformat(TODAY))
    return r.spark.read.schema(sales.schema).parquet(path)


@query
def create_tables(r: Retail) -> DataFrame:
    base = _scratch(r, "tables")
    empty = create_table(r.spark, "payments", base)
    r.payments.select(*empty.columns).write.mode("append").parquet(f"{base}/payments")
    return create_table(r.spark, "payments", base)


@query
def create_view(r: Retail) -> DataFrame:
    r.register_views("retail_")
    create_report_views(r.spark, "retail_")
    return r.spark.sql("""SELECT location, CAST(sum(total_revenue) AS DECIMAL(20,2)) AS revenue
                          FROM retail_store_revenue JOIN retail_stores USING (store_id) GROUP BY location""")


@query
def clustered_layout(r: Retail) -> DataFrame:
    path = files.export_clustered(r.orders, _scratch(r, "clustered"), ["customer_id", "order_date"], ["order_id"])
    return r.spark.read.schema(r.orders.schema).parquet(path)


# ---- projections and filters -----------------------------------------------------------


@query
def project_alias(r: Retail) -> DataFrame:
    return r.employees.select(F.col("employee_id").alias("emp_id"), F.col("name").alias("employee_name"))


@query
def join_star(r: Retail) -> DataFrame:
    return relational.customers_orders_wide(r.customers, r.unchecked_orders)


@query
def const_columns(r: Retail) -> DataFrame:
    return r.employees.select(F.col("employee_id").alias("id"), "name", F.lit(None).cast("string").alias("email"),
                              F.lit("Employee").alias("type"))


@query
def filter_eq(r: Retail) -> DataFrame:
    return relational.orders_of(r.orders, 5)


@query
def filter_ilike(r: Retail) -> DataFrame:
    return relational.matching(r.products, "name", "%RING%", ignore_case=True)


@query
def filter_like(r: Retail) -> DataFrame:
    return relational.matching(r.unchecked_customers, "email", "%@%.%")


@query
def filter_is_null(r: Retail) -> DataFrame:
    return relational.without_manager(r.employees)


@query
def filter_or_null(r: Retail) -> DataFrame:
    return relational.undated_or_before(r.unchecked_orders, "order_date", before(STALE_DAY, years=1))


@query
def filter_recent(r: Retail) -> DataFrame:
    return relational.since(r.orders, "order_date", before(TODAY, months=6))


@query
def filter_month_year(r: Retail) -> DataFrame:
    return relational.of_month(r.orders, "order_date", 12, 1999)


@query
def filter_in_list(r: Retail) -> DataFrame:
    return relational.having_value(r.payments, "payment_method", ["Cash", "UPI"])


@query
def filter_in_subquery(r: Retail) -> DataFrame:
    return relational.stale_customers(r.customers, r.orders, STALE_DAY)


@query
def filter_exists(r: Retail) -> DataFrame:
    return relational.customers_with_orders(r.customers, r.unchecked_orders)


@query
def scalar_lookup(r: Retail) -> DataFrame:
    return relational.stock_of_items(r.unchecked_items, r.products)


@query
def case_when(r: Retail) -> DataFrame:
    may = F.when(F.month("order_date") == 5, F.col("total_amount")).otherwise(0).cast("decimal(10,2)")
    return r.orders.select("order_id", may.alias("may_amount"))


# ---- joins -----------------------------------------------------------------------------


@query
def join_inner(r: Retail) -> DataFrame:
    return relational.customer_orders_inner(r.customers, r.orders)


@query
def join_left(r: Retail) -> DataFrame:
    return relational.customer_orders_left(r.customers, r.unchecked_orders)


@query
def join_right(r: Retail) -> DataFrame:
    return relational.customer_orders_right(r.customers, r.unchecked_orders)


@query
def join_full(r: Retail) -> DataFrame:
    return relational.customer_orders_full(r.customers, r.unchecked_orders)


@query
def join_self(r: Retail) -> DataFrame:
    return relational.employee_managers(r.employees)


@query
def join_fact_dim(r: Retail) -> DataFrame:
    return relational.orders_with_store(r.orders, r.stores)


@query
def join_outer_stale(r: Retail) -> DataFrame:
    return relational.stale_preview(r.customers, r.orders, STALE_DAY)


# ---- reports, pivots, hierarchy --------------------------------------------------------


@query
def top_selling_products(r: Retail) -> DataFrame:
    return reports.top_selling_products(r.order_items, r.products)


@query
def top_products(r: Retail) -> DataFrame:
    return reports.top_products(r.order_items, r.products)


@query
def store_revenue(r: Retail) -> DataFrame:
    return reports.store_revenue(r.orders, r.stores)


@query
def monthly_revenue_per_store(r: Retail) -> DataFrame:
    return reports.monthly_revenue_per_store(r.orders)


@query
def pivot_months_manual(r: Retail) -> DataFrame:
    return reports.pivot_months_manual(r.orders)


@query
def pivot_months_crosstab(r: Retail) -> DataFrame:
    return reports.pivot_months_crosstab(r.orders)


@query
def sales_report(r: Retail) -> DataFrame:
    return reports.sales_report(r.orders, 5, 1998)


@query
def customer_total_spending(r: Retail) -> DataFrame:
    return reports.customer_total_spending(r.customers, r.orders)


@query
def customer_orders(r: Retail) -> DataFrame:
    return reports.customer_orders(r.orders, 5)


@query
def customer_orders_function(r: Retail) -> DataFrame:
    r.register_views("retail_")
    create_report_functions(r.spark, "retail_")
    return r.spark.sql("SELECT * FROM retail_customer_orders(5)")


@query
def sales_report_function(r: Retail) -> DataFrame:
    r.register_views("retail_")
    create_report_functions(r.spark, "retail_")
    return r.spark.sql("SELECT * FROM retail_sales_report(5, 1998)")


@query
def employee_hierarchy(r: Retail) -> DataFrame:
    return hierarchy.employee_hierarchy(r.employees)


# ---- sorts and set operations ----------------------------------------------------------


@query
def sort_desc(r: Retail) -> DataFrame:
    return r.orders.orderBy(falling("order_date"), "order_id")


@query
def sort_asc(r: Retail) -> DataFrame:
    return r.employees.orderBy(rising("manager_id"), "employee_id")


@query
def sort_nulls_last(r: Retail) -> DataFrame:
    return r.unchecked_customers.orderBy(F.asc_nulls_last("name"), "customer_id")


@query
def union_people(r: Retail) -> DataFrame:
    again = r.customers.filter(F.col("customer_id") % 3 == 0)
    return relational.people(r.customers.unionByName(again), r.employees)


@query
def union_active_inactive(r: Retail) -> DataFrame:
    return relational.orders_by_activity(r.orders, TODAY)


# ---- rules -----------------------------------------------------------------------------


@query
def check_primary_key(r: Retail) -> DataFrame:
    return constraints.repeated_keys(r.order_items, ["order_id", "line_no"], nulls_allowed=False)


@query
def check_unique(r: Retail) -> DataFrame:
    return constraints.repeated_keys(r.unchecked_customers, ["phone"], nulls_allowed=True)


@query
def check_not_null(r: Retail) -> DataFrame:
    return constraints.row_violations(r.unchecked_customers, constraints.required_rules(TABLES["customers"]))


@query
def check_predicates(r: Retail) -> DataFrame:
    return constraints.row_violations(r.unchecked_items, constraints.check_rules(TABLES["order_items"]))


@query
def check_email(r: Retail) -> DataFrame:
    return constraints.row_violations(r.unchecked_customers, constraints.check_rules(TABLES["customers"]))


@query
def check_varchar_length(r: Retail) -> DataFrame:
    return constraints.row_violations(r.unchecked_customers, constraints.length_rules(TABLES["customers"]))


@query
def check_foreign_keys(r: Retail) -> DataFrame:
    reference = Reference("product_id", "products", "product_id")
    return constraints.broken_references(r.unchecked_items, reference, r.products)


@query
def check_all_rules(r: Retail) -> DataFrame:
    return constraints.violations(r.unchecked_customers, TABLES["customers"], {})


@query
def check_item_rules(r: Retail) -> DataFrame:
    """Row rules, a repeated key and references to products and orders, all in one report."""
    items = r.unchecked_items.withColumn("order_item_id", F.col("order_id") * 8 + F.col("line_no")).withColumn(
        "order_id", F.when(F.col("line_no") == 1, -1 - F.col("order_id")).otherwise(F.col("order_id")))
    return constraints.violations(items, TABLES["order_items"], {"products": r.products, "orders": r.orders})


@query
def swap_constraint(r: Retail) -> DataFrame:
    table = TABLES["order_items"].with_reference(Reference("order_id", "orders", "order_id"))
    reference = next(x for x in table.references if x.column == "order_id")
    returned = F.when(F.col("l_returnflag") == "R", -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    return constraints.broken_references(r.raw("lineitem").select(returned.alias("order_id")), reference, r.orders)


# ---- inserts ---------------------------------------------------------------------------

ITEM_ORDER = ("order_id", "product_id", "quantity", "price")


@query
def append_rows(r: Retail) -> DataFrame:
    cut = F.col("payment_date") < F.lit("2000-01-01").cast("timestamp_ntz")
    late = r.payments.filter(~cut)
    news = late.withColumn("amount", F.col("amount") - 150000)  # some fall to 0 or below
    return writes.append_rows(r.payments.filter(cut), news, TABLES["payments"], {"orders": r.orders},
                              mode="quarantine").state


@query
def append_order_items(r: Retail) -> DataFrame:
    stored = writes.assign_keys(r.order_items.drop("line_no"), "order_item_id", ITEM_ORDER)
    return writes.append_order_items(stored, r.unchecked_items.drop("line_no"), r.products, r.orders,
                                     mode="quarantine", order_by=ITEM_ORDER).state


@query
def assign_keys(r: Retail) -> DataFrame:
    return writes.assign_keys(r.order_items, "order_item_id", ("order_id", "line_no", *ITEM_ORDER[1:]))


def _new_suppliers(r: Retail) -> DataFrame:
    """All unchecked customers as suppliers: phones repeat, and collide with stored ones."""
    return r.unchecked_customers.select(
        F.col("customer_id").alias("supplier_id"), F.coalesce("name", "email").alias("name"),
        F.col("email").alias("contact_person"), "phone", "city")


@query
def insert_ignore(r: Retail) -> DataFrame:
    return writes.insert_unless_taken(r.suppliers, _new_suppliers(r), TABLES["suppliers"], "phone",
                                      ["supplier_id"], mode="quarantine").state


@query
def import_csv_ignore(r: Retail) -> DataFrame:
    """A file of all customers under shifted keys: some keys are missing, malformed or taken, some emails
    and phones are taken, and some names have two lines."""
    key = F.col("customer_id")
    number = (F.when(key % 13 == 0, F.lit(None)).when(key % 11 == 0, F.concat(F.lit("x"), key))
              .when(key % 7 == 0, key.cast("string")).otherwise((key + 1_000_000).cast("string")))
    news = r.unchecked_customers.select(
        number.alias("customer_id"),
        F.when(key % 4 == 0, F.concat(F.lit("one\n"), F.col("name"))).otherwise(F.col("name")).alias("name"),
        F.when(key % 5 == 0, F.col("email")).otherwise(F.concat(F.lit("n."), F.col("email"))).alias("email"),
        F.when(key % 3 == 0, F.col("phone")).otherwise(F.concat(F.lit("N"), F.substr("phone", F.lit(2)))).alias("phone"), "city")
    texts = csv.scan_csv_text(r.spark, files.export_csv(news, _scratch(r, "import")))
    return writes.import_ignore(r.customers, texts, TABLES["customers"], mode="quarantine", order_by=["customer_id"]).state


@query
def insert_text_rows(r: Retail) -> DataFrame:
    """All products once more under shifted keys, typed by hand: some values are malformed or break a rule."""
    key, table = F.col("product_id"), TABLES["products"]
    texts = r.products.select(
        (key + 1_000_000).cast("string").alias("product_id"), "name",
        F.when(key % 13 == 0, "NULL").otherwise(F.col("category")).alias("category"),
        F.when(key % 11 == 0, "cheap").when(key % 7 == 0, "-1").otherwise(F.col("price").cast("string")).alias("price"),
        F.when(key % 5 == 0, "-3").otherwise(F.col("stock").cast("string")).alias("stock"),
        F.when(F.col("category") == "PROMO", " Null ").when(key % 17 == 0, "999999999")
        .otherwise(F.col("supplier_id").cast("string")).alias("supplier_id"))
    padded = texts.select(*[F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c) for c in table.columns.names])
    return writes.insert_text_rows(r.products, padded, table, {"suppliers": r.suppliers}, mode="quarantine").state


@query
def add_customer(r: Retail) -> DataFrame:
    news = r.employees.select(
        "name", F.concat(F.lower(F.replace("name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("E"), F.col("employee_id")).alias("phone"), F.col("role").alias("city"))
    return writes.append_rows(r.customers, news, TABLES["customers"], order_by=["phone"]).state


# ---- updates ---------------------------------------------------------------------------


@query
def update_price(r: Retail) -> DataFrame:
    return writes.raise_prices(r.products, "PROMO")


@query
def publish_price_changes(r: Retail) -> DataFrame:
    """The price rise as a new version that takes over the files of all other categories."""
    base = _scratch(r, "versions")
    stored = publish_whole(r.products.repartitionByRange(8, "category", "product_id"), "priced_products", base, "1")
    promoted = stored.filter(F.col("category") == "PROMO")
    return publish_changes(stored, "priced_products", base, "2", "product_id", writes.raise_prices(promoted, "PROMO"))


@query
def add_column_default(r: Retail) -> DataFrame:
    return writes.add_hire_date(r.employees, TODAY)


@query
def update_salary(r: Retail) -> DataFrame:
    first = r.raw("lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").cast("date").alias("hire_date"))
    hired = r.employees.join(first, F.col("employee_id") - 1 == F.col("l_suppkey"), "left").drop("l_suppkey")
    return writes.raise_salaries(hired, PAYDAY)


@query
def refresh_stock(r: Retail) -> DataFrame:
    """Some products come twice with one level, some with two levels, some with a level below 0."""
    key = F.col("product_id")
    once = _shipments(r).withColumn("new_stock", F.when(key % 3 == 0, F.col("new_stock") - 45).otherwise(F.col("new_stock")))
    again = once.filter(key % 10 == 0).unionByName(once.filter(key % 7 == 0).withColumn("new_stock", F.col("new_stock") + 1))
    return writes.refresh_stock(r.products, once.unionByName(again), mode="quarantine").state


@query
def add_product_stock(r: Retail) -> DataFrame:
    returned = r.raw("lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"))
    return writes.add_stock(r.products, returned)


@query
def update_customer(r: Retail) -> DataFrame:
    """All customers move. By segment the changes lack a name, have a bad email, a long or a repeated phone, or
    (AUTOMOBILE, even keys) the next customer's phone; some customers are named twice."""
    key = F.col("customer_id")
    phone = F.when((F.col("city") == "AUTOMOBILE") & (key % 2 == 0), F.lpad((key + 1).cast("string"), 15, "0")).otherwise(
        F.col("phone"))
    moved = r.unchecked_customers.select(
        "customer_id", F.upper("name").alias("name"), "email", phone.alias("phone"), F.lit("Springfield").alias("city"))
    twice = moved.unionByName(moved.filter(key % 50 == 7))
    return writes.update_customers(r.customers, twice, mode="quarantine").state


# ---- deletes, cascades, audit ----------------------------------------------------------


def _asian_staff(r: Retail) -> DataFrame:
    shops = r.stores.filter(F.col("location") == "ASIA").select(F.col("store_id").alias("_store"))
    return r.employees.join(shops, F.col("store_id") == F.col("_store"), "left_semi")


def _empty_audit(r: Retail) -> DataFrame:
    return r.spark.createDataFrame([], TABLES["employee_audit"].columns)


@query
def delete_by_key(r: Retail) -> DataFrame:
    return writes.delete_by_key(r.employees, "employee_id", _asian_staff(r))


@query
def cascade_set_null(r: Retail) -> DataFrame:
    return writes.delete_employees(r.employees, _empty_audit(r), _asian_staff(r), TODAY).state


@query
def delete_audit(r: Retail) -> DataFrame:
    return writes.delete_employees(r.employees, _empty_audit(r), _asian_staff(r), TODAY).rows


@query
def delete_stale_customers(r: Retail) -> DataFrame:
    return relational.active_customers(r.customers, r.orders, STALE_DAY)


def _without_stale(r: Retail, *names: str) -> dict[str, DataFrame]:
    """States of the customers, the orders and the named tables after deleting stale customers."""
    held = {name: getattr(r, name) for name in ("customers", "orders", *names)}
    return writes.delete_stale_customers(held, STALE_DAY)


@query
def cascade_delete_orders(r: Retail) -> DataFrame:
    return _without_stale(r)["orders"]


@query
def cascade_delete_items(r: Retail) -> DataFrame:
    return _without_stale(r, "order_items")["order_items"]


@query
def cascade_delete_payments(r: Retail) -> DataFrame:
    return _without_stale(r, "payments")["payments"]


@query
def cascade_delete_stores(r: Retail) -> DataFrame:
    closed = r.stores.filter(F.col("location") == "ASIA").select("store_id")
    held = {**r.tables(), "employee_audit": _empty_audit(r)}
    states = writes.cascade_delete(held, {"stores": closed}, TODAY)
    sizes = [states[name].groupBy(F.lit(name).alias("table_name")).agg(F.count(F.lit(1)).alias("n_rows"))
             for name in ("stores", "employees", "orders", "order_items", "payments", "employee_audit")]
    counted = sizes[0]
    for size in sizes[1:]:
        counted = counted.unionByName(size)
    return counted


@query
def delete_customer(r: Retail) -> DataFrame:
    return writes.delete_customers(r.customers, r.unchecked_orders, r.customers.select("customer_id"),
                                   mode="quarantine").state


# ---- stock guard -----------------------------------------------------------------------


@query
def stock_guard(r: Retail) -> DataFrame:
    return guards.in_stock_items(r.order_items, r.products)


@query
def stock_guard_rejected(r: Retail) -> DataFrame:
    return guards.out_of_stock_items(r.order_items, r.products)


@query
def stock_guard_stream(r: Retail) -> DataFrame:
    items = r.order_items
    arrived, out = _scratch(r, "arrived"), _scratch(r, "judged")
    items.write.parquet(arrived)
    stream = r.spark.readStream.schema(items.schema).parquet(arrived)
    running = guard_arriving_items(stream, lambda: r.products, out, _scratch(r, "progress"))
    running.awaitTermination()
    return r.spark.read.parquet(f"{out}/accepted").select(*items.columns)


# ---- timing ----------------------------------------------------------------------------


@query
def timed_query(r: Retail) -> DataFrame:
    names = ("store_revenue", "top_selling_products", "monthly_revenue_per_store", "customer_total_spending")
    timed = timed_queries(r.spark, {n: lambda n=n: QUERIES[n](r.spark, r.folder) for n in names})
    return timed.select("query", "run", "n_rows", (F.col("seconds") > 0).alias("timed"))
