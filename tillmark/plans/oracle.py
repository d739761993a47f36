"""For each query, SQL with the same result over the raw Parquet tables (names as in the folder).

Written independently of the DataFrame code and run by another engine as a cross-check.
"""

from __future__ import annotations

_TABLES = {
    "shop": """SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS name, r_name AS location,
                      CAST(NULL AS BIGINT) AS manager_id
               FROM nation INNER JOIN region ON r_regionkey = n_regionkey""",
    "staff": """SELECT s_suppkey + 1 AS employee_id, s_name AS name,
                       CASE WHEN s_suppkey < 3 THEN 'Manager' WHEN s_suppkey % 2 = 0 THEN 'Cashier'
                            ELSE 'Sales Associate' END AS role,
                       CAST(s_nationkey AS BIGINT) AS store_id,
                       CAST(30000 + s_suppkey % 97 * 100 AS DECIMAL(10,2)) AS salary,
                       CASE WHEN s_suppkey >= 3 THEN CAST(FLOOR(s_suppkey / 3) AS BIGINT) END AS manager_id
                FROM supplier""",
    "buyer": """SELECT c_custkey AS customer_id, c_name AS name,
                       lower(replace(c_name, '#', '.')) || '@example.com' AS email,
                       lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS phone, c_mktsegment AS city
                FROM customer""",
    "vendor": """SELECT s_suppkey AS supplier_id, s_name AS name, s_name AS contact_person,
                        lpad(CAST(s_suppkey AS VARCHAR), 15, '0') AS phone, n_name AS city
                 FROM supplier INNER JOIN nation ON n_nationkey = s_nationkey""",
    "goods": """SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
                       CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size AS stock,
                       p_partkey % 10 AS supplier_id
                FROM part""",
    "sale": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 25 AS store_id,
                      o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount
               FROM orders""",
    "line": """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
                      CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price
               FROM lineitem""",
    "paid": """SELECT o_orderkey AS payment_id, o_orderkey AS order_id,
                      CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
                      CASE o_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'UPI'
                                          ELSE 'Net Banking' END AS payment_method,
                      o_orderdate AS payment_date
               FROM orders""",
    "odd_buyer": """SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS name,
                           lower(replace(c_name, '#', '.'))
                             || CASE WHEN c_mktsegment <> 'MACHINERY' THEN '@example.com'
                                     WHEN c_custkey % 3 = 0 THEN '@localhost' ELSE '' END AS email,
                           CASE c_mktsegment WHEN 'FURNITURE' THEN lpad(CAST(c_custkey AS VARCHAR), 20, '0')
                                             WHEN 'BUILDING' THEN CAST(c_nationkey AS VARCHAR)
                                             ELSE lpad(CAST(c_custkey AS VARCHAR), 15, '0') END AS phone,
                           c_mktsegment AS city
                    FROM customer""",
    "odd_sale": """SELECT o_orderkey AS order_id,
                          CASE o_orderstatus WHEN 'F' THEN o_custkey WHEN 'O' THEN -1 - o_custkey END AS customer_id,
                          o_orderkey % 25 AS store_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS order_date,
                          CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount
                   FROM orders""",
    "odd_line": """SELECT l_orderkey AS order_id, l_linenumber AS line_no,
                          CASE WHEN l_returnflag = 'R' THEN -1 - l_partkey ELSE l_partkey END AS product_id,
                          CAST(l_quantity - 5 AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price
                   FROM lineitem""",
    "stale": """SELECT customer_id FROM buyer
                WHERE NOT EXISTS (SELECT * FROM sale WHERE sale.customer_id = buyer.customer_id)
                   OR EXISTS (SELECT * FROM sale WHERE sale.customer_id = buyer.customer_id
                              AND (order_date IS NULL OR order_date < TIMESTAMP '1995-02-01'))""",
    "dead_sale": "SELECT order_id FROM sale WHERE customer_id IN (SELECT customer_id FROM stale)",
    "leaver": """SELECT employee_id FROM staff
                 WHERE store_id IN (SELECT store_id FROM shop WHERE location = 'ASIA')""",
}
# Which other tables above a table is built from.
_NEEDS = {"stale": ("buyer", "sale"), "dead_sale": ("stale",), "leaver": ("staff", "shop")}


def _with(tables: str, body: str, recursive: str = "") -> str:
    """``body`` over the named tables, as one statement."""
    names: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        if name not in names:
            names.append(name)

    for name in tables.split():
        need(name)
    parts = [f"{name} AS ({_TABLES[name]})" for name in names]
    if recursive:
        parts.append(recursive)
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


_SPENT = "CAST(sum(total_amount) AS DECIMAL(20,2))"
_PAIR = "b.customer_id, b.name, s.order_id, s.order_date, s.total_amount"
_WIDE = "b.*, s.order_id, s.customer_id AS order_customer_id, s.store_id, s.order_date, s.total_amount"
_BEST = """SELECT l.product_id, g.name AS product_name, CAST(l.n AS BIGINT) AS total_sold
           FROM (SELECT product_id, sum(quantity) AS n FROM line GROUP BY 1) l, goods g
           WHERE g.product_id = l.product_id"""
_MONTHLY = f"SELECT store_id, strftime(order_date, '%Y-%m') AS month, {_SPENT} AS total_revenue FROM sale GROUP BY 1, 2"
_SPENDING = f"SELECT customer_id, any_value(b.name) AS name, {_SPENT} AS total_spending FROM sale INNER JOIN buyer b USING (customer_id) GROUP BY 1"
_REVENUE = f"SELECT store_id, any_value(shop.name) AS store_name, {_SPENT} AS total_revenue FROM shop INNER JOIN sale USING (store_id) GROUP BY 1"
_DAILY = """SELECT strftime(order_date, '%Y-%m-%d') AS "Date", goods.name AS "Product",
                   CAST(floor(sum(line.price)) AS BIGINT) AS "Revenue"
            FROM line INNER JOIN sale USING (order_id) INNER JOIN goods USING (product_id) GROUP BY 1, 2"""
_SHIPPED = "SELECT product_id, max(quantity) AS new_stock FROM line GROUP BY 1"


def _awkward(key: str, name: str) -> str:
    return f"""CASE {key} % 5 WHEN 0 THEN '  ' || {name} || ' ' WHEN 1 THEN '' WHEN 2 THEN 'say "' || {name} || '", ok'
               WHEN 3 THEN 'one' || chr(10) || {name} ELSE {name} END"""


def _month_cells() -> str:
    names = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    return ", ".join(
        f"CAST(sum(if(month(order_date) = {n}, total_amount, 0)) AS DECIMAL(20,2)) AS \"{name}\""
        for n, name in enumerate(names, 1))


def _quarter_cells() -> str:
    names = {"January": "january", "February": "febrauary", "March": "march", "April": "april"}
    return ", ".join(
        f"CAST(sum(total_amount) FILTER (WHERE strftime(order_date, '%B') = '{month}') AS DECIMAL(20,2)) AS {name}"
        for month, name in names.items())


def _broken(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT *, '{name}' AS rule FROM {table} WHERE {test}" for name, test in rules.items())


# Raw table that each retail table has one row per row of, and the retail tables' columns.
_SOURCES = {"stores": "nation", "employees": "supplier", "customers": "customer", "suppliers": "supplier",
            "products": "part", "orders": "orders", "order_items": "lineitem", "payments": "orders"}
_BUILT = {"stores": "shop", "employees": "staff", "customers": "buyer", "suppliers": "vendor", "products": "goods",
          "orders": "sale", "order_items": "line", "payments": "paid"}
_COLUMNS = {
    "stores": "store_id name location manager_id",
    "employees": "employee_id name role store_id salary manager_id",
    "customers": "customer_id name email phone city",
    "suppliers": "supplier_id name contact_person phone city",
    "products": "product_id name category price stock supplier_id",
    "orders": "order_id customer_id store_id order_date total_amount",
    "order_items": "order_id line_no product_id quantity price",
    "payments": "payment_id order_id amount payment_method payment_date",
}
_REQUIRED = {f"required {c}": f"{c} IS NULL" for c in ("name", "email", "phone", "city")}
_LENGTHS = {f"length {c}": f"length({c}) > {n}" for c, n in (("name", 255), ("email", 255), ("phone", 15), ("city", 100))}
_EMAIL = {"check email LIKE ''%@%.%''": "NOT (email LIKE '%@%.%')"}


def _report_part(rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(NULL AS VARCHAR) AS value, count(*) AS n_rows FROM odd_buyer WHERE {test} HAVING count(*) > 0"
        for name, test in rules.items())


ORACLE: dict[str, str] = {
    # sources
    "scan_table": _with("goods", "SELECT * FROM goods"),
    "scan_csv": _with("buyer", "SELECT * FROM buyer"),
    "query_to_frame": _with("sale", f"""SELECT customer_id, count(*) AS n_orders, {_SPENT} AS spent FROM sale
        WHERE order_date >= TIMESTAMP '1999-01-01' AND total_amount >= 100000 GROUP BY ALL"""),
    "fetch_rows": _with("shop sale", _REVENUE),
    "rows_to_frame": "SELECT CAST(month(o_orderdate) AS INT) AS month, count(*) AS n_orders FROM orders GROUP BY 1",
    "values_rows": _with("paid", """SELECT v.payment_method, CAST(sum(amount) AS DECIMAL(20,2)) AS paid
        FROM (VALUES ('Cash'), ('Credit Card'), ('UPI'), ('Net Banking'), ('Cheque')) v(payment_method)
        LEFT JOIN paid ON paid.payment_method = v.payment_method GROUP BY 1"""),
    "temp_table": _with("line", _SHIPPED),
    "list_tables": " UNION ALL ".join(
        f"SELECT 'retail_{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in _SOURCES.items()),
    "list_columns": _with(" ".join(_BUILT.values()), " UNION ALL ".join(
        f"SELECT 'retail_{table}' AS table_name, '{column}' AS column_name, {place} AS place, count({column}) AS n_values "
        f"FROM {_BUILT[table]}" for table, columns in _COLUMNS.items() for place, column in enumerate(columns.split(), 1))),
    # sinks
    "export_csv": _with("line goods", f"SELECT * REPLACE ({_awkward('product_id', 'product_name')} AS product_name) FROM ({_BEST})"),
    "export_columns_csv": f"SELECT p_partkey AS product_id, {_awkward('p_partkey', 'p_name')} AS name, p_size AS stock FROM part",
    "export_report": _with("sale", f"""SELECT m.*, f.format FROM ({_MONTHLY}) m,
        (VALUES ('csv'), ('parquet')) f(format)"""),
    "copy_query_csv": _with("sale buyer", f"SELECT * REPLACE ({_awkward('customer_id', 'name')} AS name) FROM ({_SPENDING})"),
    "copy_table_csv": _with("staff", f"SELECT * REPLACE ({_awkward('employee_id', 'name')} AS name) FROM staff"),
    "sales_report_job": _with("line sale goods", _DAILY),
    "create_tables": _with("paid", "SELECT * FROM paid"),
    "create_view": _with("shop sale", f"SELECT location, {_SPENT} AS revenue FROM sale INNER JOIN shop USING (store_id) GROUP BY 1"),
    "clustered_layout": _with("sale", "SELECT * FROM sale"),
    # projections and filters
    "project_alias": "SELECT s_suppkey + 1 AS emp_id, s_name AS employee_name FROM supplier",
    "join_star": _with("buyer odd_sale", f"SELECT {_WIDE} FROM odd_sale s RIGHT JOIN buyer b ON b.customer_id = s.customer_id"),
    "const_columns": "SELECT s_suppkey + 1 AS id, s_name AS name, CAST(NULL AS VARCHAR) AS email, 'Employee' AS type FROM supplier",
    "filter_eq": _with("sale", "SELECT * FROM sale WHERE customer_id IN (5)"),
    "filter_ilike": _with("goods", "SELECT * FROM goods WHERE contains(lower(name), 'ring')"),
    "filter_like": _with("odd_buyer", "SELECT * FROM odd_buyer WHERE regexp_matches(email, '@.*[.]')"),
    "filter_is_null": _with("staff", "SELECT * FROM staff WHERE manager_id IS NULL"),
    "filter_or_null": _with("odd_sale", "SELECT * FROM odd_sale WHERE order_date IS NULL OR order_date < TIMESTAMP '1996-02-01'"),
    "filter_recent": _with("sale", "SELECT * FROM sale WHERE NOT order_date < TIMESTAMP '2001-08-01' - INTERVAL '6' MONTH"),
    "filter_month_year": _with("sale", "SELECT * FROM sale WHERE month(order_date) = 12 AND year(order_date) = 1999"),
    "filter_in_list": _with("paid", "SELECT * FROM paid WHERE payment_method = 'UPI' OR payment_method = 'Cash'"),
    "filter_in_subquery": _with("stale", "SELECT * FROM buyer WHERE customer_id IN (FROM stale)"),
    "filter_exists": _with("buyer", "SELECT * FROM buyer WHERE EXISTS (FROM orders WHERE o_custkey = customer_id AND o_orderstatus = 'F')"),
    "scalar_lookup": _with("odd_line goods", """SELECT order_id, line_no, product_id, quantity, price,
        (SELECT max(stock) FROM goods WHERE goods.product_id = odd_line.product_id) AS stock FROM odd_line"""),
    "case_when": _with("sale", "SELECT order_id, if(month(order_date) = 5, total_amount, CAST(0 AS DECIMAL(10,2))) AS may_amount FROM sale"),
    # joins
    "join_inner": _with("buyer sale", f"SELECT {_PAIR} FROM buyer b, sale s WHERE s.customer_id = b.customer_id"),
    "join_left": _with("buyer odd_sale", f"SELECT {_PAIR} FROM buyer b LEFT JOIN odd_sale s ON s.customer_id = b.customer_id"),
    "join_right": _with("buyer odd_sale", f"SELECT {_PAIR} FROM odd_sale s LEFT JOIN buyer b ON s.customer_id = b.customer_id"),
    "join_full": _with("buyer odd_sale", f"SELECT {_PAIR} FROM odd_sale s FULL OUTER JOIN buyer b ON s.customer_id = b.customer_id"),
    "join_self": _with("staff", """SELECT x.employee_id AS emp_id, x.name AS employee_name, y.employee_id AS manager_id,
        y.name AS manager_name FROM staff x LEFT JOIN staff y ON y.employee_id = x.manager_id"""),
    "join_fact_dim": _with("sale shop", """SELECT order_id, store_id, shop.name AS store_name, order_date, total_amount
        FROM sale INNER JOIN shop USING (store_id)"""),
    "join_outer_stale": _with("buyer sale", f"""SELECT {_WIDE} FROM buyer b LEFT JOIN sale s ON s.customer_id = b.customer_id
        WHERE s.order_date IS NULL OR s.order_date < TIMESTAMP '1997-02-01' - INTERVAL '2' YEAR"""),
    # reports, pivots, hierarchy
    "top_selling_products": _with("line goods", _BEST),
    "top_products": _with("line goods", f"{_BEST} ORDER BY total_sold DESC, l.product_id LIMIT 10"),
    "store_revenue": _with("shop sale", _REVENUE),
    "monthly_revenue_per_store": _with("sale", _MONTHLY),
    "pivot_months_manual": _with("sale", f"SELECT store_id, {_month_cells()} FROM sale GROUP BY 1"),
    "pivot_months_crosstab": _with("sale", f"SELECT store_id, {_quarter_cells()} FROM sale GROUP BY 1"),
    "sales_report": _with("sale", f"""SELECT store_id, {_SPENT} AS total_sales FROM sale
        WHERE strftime(order_date, '%Y-%m') = '1998-05' GROUP BY 1"""),
    "customer_total_spending": _with("sale buyer", _SPENDING),
    "customer_orders": _with("sale", "SELECT order_id, store_id, order_date, total_amount FROM sale WHERE customer_id = 5"),
    "employee_hierarchy": _with("staff", """SELECT s.employee_id, s.name, s.role, s.manager_id, CAST(depth AS INT) AS level
        FROM tree INNER JOIN staff s USING (employee_id)""", recursive="""tree(employee_id, depth) AS (
        SELECT employee_id, 1 FROM staff WHERE manager_id IS NULL
        UNION ALL SELECT below.employee_id, depth + 1 FROM tree, staff below WHERE below.manager_id = tree.employee_id)"""),
    # sorts and set operations
    "sort_desc": _with("sale", "SELECT * FROM sale ORDER BY order_date DESC NULLS FIRST, order_id"),
    "sort_asc": _with("staff", "SELECT * FROM staff ORDER BY manager_id NULLS LAST, employee_id"),
    "sort_nulls_last": _with("odd_buyer", "SELECT * FROM odd_buyer ORDER BY name NULLS LAST, customer_id"),
    "union_people": _with("buyer staff", """SELECT customer_id AS id, name, email, 'Customer' AS type
        FROM (SELECT * FROM buyer UNION ALL SELECT * FROM buyer WHERE customer_id % 3 = 0)
        UNION SELECT employee_id, name, NULL, 'Employee' FROM staff"""),
    "union_active_inactive": _with("sale", """SELECT *, 'Active' AS status FROM sale WHERE order_date >= TIMESTAMP '2001-02-01'
        UNION ALL SELECT *, 'Inactive' FROM sale WHERE order_date < TIMESTAMP '2001-02-01'"""),
    # rules
    "check_primary_key": "SELECT l_orderkey AS order_id, l_linenumber AS line_no, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "check_unique": _with("odd_buyer", "SELECT phone, count(*) AS n_rows FROM odd_buyer WHERE phone IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    "check_not_null": _with("odd_buyer", _broken("odd_buyer", _REQUIRED)),
    "check_predicates": _with("odd_line", _broken("odd_line", {
        "check quantity > 0": "quantity <= 0", "check price > 0": "price <= 0"})),
    "check_email": _with("odd_buyer", _broken("odd_buyer", _EMAIL)),
    "check_varchar_length": _with("odd_buyer", _broken("odd_buyer", _LENGTHS)),
    "check_foreign_keys": _with("odd_line", """SELECT product_id, count(*) AS n_rows FROM odd_line
        WHERE product_id NOT IN (SELECT p_partkey FROM part) GROUP BY 1"""),
    "check_all_rules": _with("odd_buyer", _report_part({**_REQUIRED, **_LENGTHS, **_EMAIL}) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{name}', CAST({key} AS VARCHAR), count(*) FROM odd_buyer WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
        for name, key in (("primary key", "customer_id"), ("unique email", "email"), ("unique phone", "phone")))),
    "check_item_rules": _with("odd_line", """, item AS (
        SELECT * REPLACE (CASE WHEN line_no = 1 THEN -1 - order_id ELSE order_id END AS order_id),
               order_id * 8 + line_no AS order_item_id FROM odd_line)
        SELECT 'check quantity > 0' AS rule, CAST(NULL AS VARCHAR) AS value, count(*) AS n_rows FROM item
            WHERE quantity <= 0 HAVING count(*) > 0
        UNION ALL SELECT 'check price > 0', NULL, count(*) FROM item WHERE price <= 0 HAVING count(*) > 0
        UNION ALL SELECT 'primary key', CAST(order_item_id AS VARCHAR), count(*) FROM item GROUP BY order_item_id HAVING count(*) > 1
        UNION ALL SELECT 'reference product_id', CAST(product_id AS VARCHAR), count(*) FROM item
            WHERE product_id NOT IN (SELECT p_partkey FROM part) GROUP BY product_id
        UNION ALL SELECT 'reference order_id', CAST(order_id AS VARCHAR), count(*) FROM item
            WHERE order_id NOT IN (SELECT o_orderkey FROM orders) GROUP BY order_id"""),
    "swap_constraint": """SELECT * FROM (
        SELECT CASE WHEN l_returnflag = 'R' THEN -1 - l_orderkey ELSE l_orderkey END AS order_id, count(*) AS n_rows
        FROM lineitem GROUP BY 1) WHERE order_id NOT IN (SELECT o_orderkey FROM orders)""",
    # inserts
    "append_rows": _with("paid", """SELECT * FROM paid WHERE payment_date < TIMESTAMP '2000-01-01'
        UNION ALL SELECT payment_id, order_id, CAST(amount - 150000 AS DECIMAL(10,2)), payment_method, payment_date
        FROM paid WHERE payment_date >= TIMESTAMP '2000-01-01' AND amount > 150000"""),
    "append_order_items": _with("line odd_line goods", """
        SELECT row_number() OVER (ORDER BY order_id, product_id, quantity, price) AS order_item_id,
               order_id, product_id, quantity, price FROM line
        UNION ALL
        SELECT * FROM (
            SELECT row_number() OVER (ORDER BY o.order_id, o.product_id, quantity, o.price) + (SELECT count(*) FROM line),
                   o.order_id, o.product_id, quantity, o.price
            FROM odd_line o LEFT JOIN goods g ON g.product_id = o.product_id
            WHERE g.stock IS NULL OR g.stock >= quantity) n
        WHERE n.quantity > 0 AND n.product_id >= 0"""),
    "assign_keys": _with("line", "SELECT row_number() OVER (ORDER BY order_id, line_no, product_id, quantity, price) AS order_item_id, * FROM line"),
    "insert_ignore": _with("vendor odd_buyer", """SELECT * FROM vendor UNION ALL
        SELECT supplier_id, name, contact_person, phone, city FROM (
            SELECT customer_id AS supplier_id, coalesce(name, email) AS name, email AS contact_person, phone, city,
                   row_number() OVER (PARTITION BY phone ORDER BY customer_id) AS turn
            FROM odd_buyer
            WHERE coalesce(name, email) IS NOT NULL AND email IS NOT NULL AND phone IS NOT NULL AND city IS NOT NULL
              AND length(phone) <= 15 AND phone NOT IN (SELECT phone FROM vendor))
        WHERE turn = 1 AND supplier_id NOT IN (SELECT supplier_id FROM vendor)"""),
    "import_csv_ignore": _with("buyer odd_buyer", """, arrived AS (
        SELECT CASE WHEN customer_id % 13 = 0 THEN NULL WHEN customer_id % 11 = 0 THEN 'x' || customer_id
                    WHEN customer_id % 7 = 0 THEN CAST(customer_id AS VARCHAR) ELSE CAST(customer_id + 1000000 AS VARCHAR) END AS text_id,
               CASE WHEN customer_id % 4 = 0 THEN 'one' || chr(10) || name ELSE name END AS name,
               CASE WHEN customer_id % 5 = 0 THEN email ELSE 'n.' || email END AS email,
               CASE WHEN customer_id % 3 = 0 THEN phone ELSE 'N' || substr(phone, 2) END AS phone, city FROM odd_buyer),
        sound AS (
        SELECT TRY_CAST(text_id AS BIGINT) AS customer_id, name, email, phone, city FROM arrived
        WHERE TRY_CAST(text_id AS BIGINT) IS NOT NULL AND name IS NOT NULL AND email LIKE '%@%.%' AND length(phone) <= 15)
        SELECT * FROM buyer UNION ALL SELECT * FROM (
        SELECT * FROM sound WHERE customer_id NOT IN (SELECT customer_id FROM buyer) AND email NOT IN (SELECT email FROM buyer)
          AND phone NOT IN (SELECT phone FROM buyer)
        QUALIFY row_number() OVER (PARTITION BY phone ORDER BY customer_id) = 1)"""),
    "insert_text_rows": _with("goods", """SELECT * FROM goods UNION ALL
        SELECT product_id + 1000000, name, category, price, stock, CASE WHEN category <> 'PROMO' THEN supplier_id END
        FROM goods WHERE product_id % 13 <> 0 AND product_id % 11 <> 0 AND product_id % 7 <> 0 AND product_id % 5 <> 0
          AND (category = 'PROMO' OR product_id % 17 <> 0) AND price > 0 AND stock >= 0
          AND (category = 'PROMO' OR supplier_id IN (SELECT s_suppkey FROM supplier))"""),
    "add_customer": _with("buyer staff", """SELECT * FROM buyer UNION ALL
        SELECT (SELECT max(customer_id) FROM buyer) + row_number() OVER (ORDER BY 'E' || employee_id), name,
               lower(replace(name, '#', '.')) || '@example.com', 'E' || employee_id, role FROM staff"""),
    # updates
    "update_price": _with("goods", """SELECT * REPLACE (CAST(CASE category WHEN 'PROMO' THEN price * 1.10 ELSE price END
        AS DECIMAL(10,2)) AS price) FROM goods"""),
    "publish_price_changes": _with("goods", """SELECT * REPLACE (CAST(CASE category WHEN 'PROMO' THEN price * 1.10 ELSE price END
        AS DECIMAL(10,2)) AS price) FROM goods"""),
    "add_column_default": _with("staff", "SELECT *, DATE '1995-08-01' AS hire_date FROM staff"),
    "update_salary": _with("staff", """SELECT employee_id, name, role, store_id,
        CAST(CASE WHEN hire_date <= TIMESTAMP '1995-06-01' THEN salary * 1.15 ELSE salary END AS DECIMAL(10,2)) AS salary,
        manager_id, hire_date FROM staff LEFT JOIN
        (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS hire_date FROM lineitem GROUP BY 1) ON l_suppkey + 1 = employee_id"""),
    "refresh_stock": _with("goods line", f"""SELECT product_id, name, category, price,
        CASE WHEN new_stock IS NULL OR product_id % 7 = 0 OR new_stock - if(product_id % 3 = 0, 45, 0) < 0 THEN stock
             ELSE new_stock - if(product_id % 3 = 0, 45, 0) END AS stock, supplier_id
        FROM goods LEFT JOIN ({_SHIPPED}) USING (product_id)"""),
    "add_product_stock": _with("goods", """SELECT product_id, name, category, price,
        CAST(stock + coalesce((SELECT sum(l_quantity) FROM lineitem WHERE l_partkey = product_id AND l_returnflag = 'R'), 0) AS INT) AS stock,
        supplier_id FROM goods"""),
    "update_customer": _with("buyer odd_buyer", """, moved AS (
        SELECT customer_id, upper(name) AS name, email, CASE WHEN city = 'AUTOMOBILE' AND customer_id % 2 = 0
               THEN lpad(CAST(customer_id + 1 AS VARCHAR), 15, '0') ELSE phone END AS phone FROM odd_buyer
        WHERE customer_id % 50 <> 7),
        sound AS (SELECT * FROM moved WHERE name IS NOT NULL AND email LIKE '%@%.%' AND length(phone) <= 15),
        alone AS (SELECT * FROM sound s
        WHERE NOT EXISTS (FROM sound o WHERE o.customer_id <> s.customer_id AND (o.phone = s.phone OR o.email = s.email))
          AND NOT EXISTS (FROM buyer o WHERE o.customer_id <> s.customer_id AND (o.phone = s.phone OR o.email = s.email)))
        SELECT b.customer_id, coalesce(a.name, b.name) AS name, coalesce(a.email, b.email) AS email,
               coalesce(a.phone, b.phone) AS phone, if(a.customer_id IS NULL, b.city, 'Springfield') AS city
        FROM buyer b LEFT JOIN alone a USING (customer_id)"""),
    # deletes, cascades, audit
    "delete_by_key": _with("leaver", "SELECT * FROM staff WHERE employee_id NOT IN (FROM leaver)"),
    "cascade_set_null": _with("leaver", """SELECT * REPLACE (CASE WHEN manager_id IN (FROM leaver) THEN NULL ELSE manager_id END
        AS manager_id) FROM staff WHERE employee_id NOT IN (FROM leaver)"""),
    "delete_audit": _with("leaver", """SELECT row_number() OVER (ORDER BY employee_id) AS audit_id, employee_id, name, role, store_id,
        salary, TIMESTAMP '2001-08-01' AS deleted_at FROM staff WHERE employee_id IN (FROM leaver)"""),
    "delete_stale_customers": _with("stale", "SELECT * FROM buyer WHERE customer_id NOT IN (FROM stale)"),
    "cascade_delete_orders": _with("dead_sale", "SELECT * FROM sale WHERE order_id NOT IN (FROM dead_sale)"),
    "cascade_delete_items": _with("dead_sale line", "SELECT * FROM line WHERE order_id NOT IN (FROM dead_sale)"),
    "cascade_delete_payments": _with("dead_sale paid", "SELECT * FROM paid WHERE order_id NOT IN (FROM dead_sale)"),
    "cascade_delete_stores": _with("leaver sale line paid", """
        SELECT 'stores' AS table_name, count(*) AS n_rows FROM shop WHERE location <> 'ASIA'
        UNION ALL SELECT 'employees', count(*) FROM staff WHERE employee_id NOT IN (FROM leaver)
        UNION ALL SELECT 'employee_audit', count(*) FROM leaver
        UNION ALL SELECT 'orders', count(*) FROM sale WHERE store_id IN (SELECT store_id FROM shop WHERE location <> 'ASIA')
        UNION ALL SELECT 'order_items', count(*) FROM line INNER JOIN sale USING (order_id) INNER JOIN shop USING (store_id) WHERE location <> 'ASIA'
        UNION ALL SELECT 'payments', count(*) FROM paid INNER JOIN sale USING (order_id) INNER JOIN shop USING (store_id) WHERE location <> 'ASIA'"""),
    "delete_customer": _with("buyer", "SELECT * FROM buyer WHERE customer_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"),
    # stock guard
    "stock_guard": _with("line goods", "SELECT line.* FROM line INNER JOIN goods USING (product_id) WHERE stock >= quantity"),
    "stock_guard_rejected": _with("line goods", "SELECT line.*, stock FROM line INNER JOIN goods USING (product_id) WHERE stock < quantity"),
    "stock_guard_stream": _with("line goods", "SELECT line.* FROM line INNER JOIN goods USING (product_id) WHERE NOT stock < quantity"),
}
ORACLE["timed_query"] = " UNION ALL ".join(
    f"SELECT '{name}' AS query, 1 AS run, (SELECT count(*) FROM ({ORACLE[name]})) AS n_rows, true AS timed"
    for name in ("store_revenue", "top_selling_products", "monthly_revenue_per_store", "customer_total_spending"))
for _same in ("customer_orders", "sales_report"):
    ORACLE[f"{_same}_function"] = ORACLE[_same]
