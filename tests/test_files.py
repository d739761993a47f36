"""Files, tables, views, the report job, the stream and the plans."""

import csv as pycsv
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tests.seed import shop
from tillmark import session
from tillmark.operators import keyed, relational, reports, writes
from tillmark.plans.measure import explain_query, explain_run, timed_queries
from tillmark.plans.queries import QUERIES
from tillmark.schema import SALES, SHIPMENTS, TABLES
from tillmark.sinks import files, jobs
from tillmark.sinks.tables import create_report_views, create_tables, publish
from tillmark.sources import csv, jdbc, tables
from tillmark.sources.retail import Retail
from tillmark.streaming.stock import guard_arriving_items


@pytest.fixture(scope="module")
def t(spark):
    return shop(spark)


def lines(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return [line for p in parts for line in open(f"{path}/{p}").read().splitlines()]


def test_csv_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you'), (2, None), (3, "")], "a int, b string").coalesce(1)
    path = files.export_csv(df, str(tmp_path / "out"))
    assert lines(path) == ["a,b", '1,"say ""hi"", you"', "2,", '3,""']
    back = csv.scan_csv(spark, path, df.schema).filter("a = 1").first()
    assert back["b"] == 'say "hi", you'


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    rows = [(1, "  a "), (2, ""), (3, None), (4, 'x"y, "z"'), (5, " two\n lines \n"), (6, "\ttab\t"), (7, '"')]
    df = spark.createDataFrame(rows, "a int, b string")
    path = files.export_csv(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in csv.scan_csv(spark, path, df.schema, line_breaks=True).collect()) == rows
    assert sorted(tuple(r) for r in csv.scan_csv_text(spark, path).collect()) == [(str(a), b) for a, b in rows]


def test_csv_types_and_nulls(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,NA\n,x\n")
    path = str(tmp_path / "in.csv")
    assert csv.scan_csv(spark, path).dtypes == [("a", "int"), ("b", "string")]
    assert [r["b"] for r in csv.scan_csv(spark, path, null_value="NA").collect()] == [None, "x"]
    (tmp_path / "bad.csv").write_text("product_id,new_stock\n1,many\n")
    with pytest.raises(Exception, match="MALFORMED"):
        csv.scan_csv(spark, str(tmp_path / "bad.csv"), SHIPMENTS).collect()


def test_csv_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "two\nlines"), (2, "one")], "a int, b string")
    path = files.export_csv(df, str(tmp_path / "out"))
    back = csv.scan_csv(spark, path, df.schema, line_breaks=True)
    assert {tuple(r) for r in back.collect()} == {(1, "two\nlines"), (2, "one")}


def _write_awkward(folder, n, seed=1, ends="\n", signs=("x", '"', "\n", ",", "é", " ", "\n\n")):
    """Files of records with quotes, commas and line breaks in their values; the rows as written."""
    draw, rows = random.Random(seed), []
    with open(folder / f"f{seed}.csv", "w", newline="") as out:
        writer = pycsv.writer(out, lineterminator=ends)
        writer.writerow(["a", "b c", "d.e"])
        for i in range(n):
            rows.append((str(i), "".join(draw.choice(signs) for _ in range(draw.randrange(40))), draw.choice(["", "z", "  p "])))
            writer.writerow(rows[-1])
    return rows


@pytest.mark.parametrize("split", [300, 20_000, 10**8])
def test_line_breaks_over_splits(spark, tmp_path, split):
    """Values longer than a split, splits that begin inside a value: the same rows as Spark's own reader, in file order."""
    rows = _write_awkward(tmp_path, 400) + _write_awkward(tmp_path, 200, 2)
    (tmp_path / "f3.csv").write_text('a,b c,d.e\n900,"' + "long\n,\n" * 300 + '",z\n\n901,"",\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        reader = spark.read.option("header", True).option("escape", '"').option("nullValue", csv.NO_TEXT).option("multiLine", True)
        own = sorted((tuple(r) for r in reader.csv(str(tmp_path)).collect()), key=str)
        found = csv.scan_csv_text(spark, str(tmp_path), position="at")
        got = sorted(found.collect(), key=lambda r: r["at"])
        assert sorted((tuple(r)[:3] for r in got), key=str) == own
        assert [int(r[0]) for r in got] == [int(r[0]) for r in rows] + [900, 901]
        if split == 300:
            assert csv.quoted_records(spark, str(tmp_path)).select("file", "start").distinct().count() > 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_breaks_with_carriage_returns(spark, tmp_path):
    """Values come back as they were written, also where lines end with carriage return and line feed."""
    rows = _write_awkward(tmp_path, 300, 3, "\r\n", ("x", '"', "\r\n", "\n", ","))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        got = csv.scan_csv_text(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r[0], r[1] or "", r[2] or "") for r in got) == sorted(rows)


def test_more_open_splits_than_can_be_sent(spark, tmp_path, monkeypatch):
    rows = _write_awkward(tmp_path, 200, 4)
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        assert csv.quoted_records(spark, str(tmp_path)) is None
        got = csv.scan_csv_text(spark, str(tmp_path), position="at").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[0] for r in sorted(got, key=lambda r: r["at"])] == [r[0] for r in rows]


def test_empty_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n")
    assert csv.scan_csv_text(spark, str(tmp_path)).collect() == []
    assert csv.scan_csv_text(spark, str(tmp_path)).columns == ["a", "b"]


def test_import_in_file_order(spark, tmp_path):
    """Of rows that collide the first in the file goes in, also where a record crosses splits."""
    lines = [f'{i},"name\n{i}",n{i // 2}@x.y,{i},"c\nd"' for i in range(60)]
    (tmp_path / "in.csv").write_text("\n".join(["customer_id,name,email,phone,city", *lines]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        texts = csv.scan_csv_text(spark, str(tmp_path), position="at")
        change = writes.import_ignore(spark.createDataFrame([], TABLES["customers"].columns), texts, TABLES["customers"], place="at")
        assert sorted(r["customer_id"] for r in change.rows.collect()) == list(range(0, 60, 2))
        assert change.state.columns == TABLES["customers"].columns.names
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sorted_export_keeps_its_order(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") * 37 % 1000).orderBy(F.desc("v"), "id")
    path = files.export_csv(df, str(tmp_path / "sorted"))
    values = [int(x.split(",")[1]) for x in lines(path) if x != "id,v"]
    assert values == sorted(values, reverse=True) and len(values) == 1000


def test_chosen_columns(t):
    assert files.chosen_columns(t["stores"], " store_id , name").columns == ["store_id", "name"]
    assert files.chosen_columns(t["stores"], "*").columns == t["stores"].columns
    with pytest.raises(ValueError, match="no such"):
        files.chosen_columns(t["stores"], "name; DROP TABLE stores")


def test_report_in_two_formats(spark, t, tmp_path):
    report = reports.store_revenue(t["orders"], t["stores"])
    parquet, text = files.export_report(report, str(tmp_path / "r"), [F.desc("total_revenue")])
    assert spark.read.parquet(parquet).count() == 5
    expected = [str(r["store_id"]) for r in sorted(report.collect(), key=lambda r: -r["total_revenue"])]
    assert [x.split(",")[0] for x in lines(text) if x[0] != "s"] == expected


def test_report_job_replaces_its_month(spark, tmp_path):
    base = str(tmp_path / "reports")
    sales = tables.rows_to_frame(spark, [{"Date": "2025-03-14", "Product": "Kettle", "Revenue": 310}], SALES)
    jobs.sales_report_job(sales, base, dt.date(2025, 1, 9))
    path = jobs.sales_report_job(sales, base, dt.date(2025, 2, 1))
    assert path.endswith("report_month=2025-02")
    jobs.sales_report_job(sales.withColumn("Revenue", F.lit(5).cast("bigint")), base, dt.date(2025, 2, 28))
    found = {(r["report_month"], r["Revenue"]) for r in spark.read.parquet(base).collect()}
    assert found == {("2025-01", 310), ("2025-02", 5)}


def test_tables_views_catalog(spark, t, tmp_path):
    base = str(tmp_path / "db")
    made = create_tables(spark, base)
    assert made["payments"].schema == TABLES["payments"].columns and made["payments"].isEmpty()
    t["stores"].write.mode("append").parquet(f"{base}/stores")
    assert create_tables(spark, base)["stores"].count() == 5  # not replaced
    for name in ("orders", "stores", "products", "order_items"):
        publish(t[name], name, base + "/versions", "1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        publish(t["orders"], "orders", base + "/versions", "1")
    create_report_views(spark)
    create_report_views(spark)
    assert spark.sql("SELECT count(*) FROM store_revenue").first()[0] == 5
    names = {r[0] for r in tables.list_tables(spark).collect()}
    assert {"store_revenue", "top_selling_products", "orders", "payments"} <= names
    assert tables.list_columns(spark, "stores") == ["store_id", "name", "location", "manager_id"]
    assert tables.list_columns(spark, "nothing") == []
    assert tables.scan_table(spark, f"{base}/stores", TABLES["stores"].columns).count() == 5
    assert [r[0] for r in tables.fetch_rows(spark.range(0, 3000, 1, 7))] == list(range(3000))
    found = tables.query_to_frame(spark, "SELECT name FROM stores WHERE name = :n", {"n": "x' OR '1'='1"})
    assert found.isEmpty()


def test_clustered_files_split_a_large_key(spark, tmp_path):
    orders = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("customer_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("order_date"), F.col("id").alias("order_id"))
    path = files.export_clustered(orders, str(tmp_path / "c"), ["customer_id", "order_date"], ["order_id"], files=9)
    sizes = [r[1] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 9000 / 4
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    ranges = sorted((r[1], r[2]) for r in back.groupBy("f").agg(F.min("customer_id"), F.max("customer_id")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_shipments_table(spark, tmp_path):
    (tmp_path / "s.csv").write_text("product_id,new_stock\n1,5\n2,\n")
    csv.shipments_table(spark, str(tmp_path / "s.csv"))
    assert [tuple(r) for r in spark.table("temp_shipments").collect()] == [(1, 5), (2, None)]


def test_jdbc_options():
    env = {"PGHOST": "h", "PGDATABASE": "d", "PGUSER": "u", "PGPASSWORD": "p"}
    options = jdbc.jdbc_options("orders", "order_id", 1, 1000, 8, env)
    assert options["url"] == "jdbc:postgresql://h:5432/d"
    assert (options["partitionColumn"], options["numPartitions"]) == ("order_id", "8")


def test_stream_in_two_runs(spark, tmp_path):
    r = Retail(spark, FOLDER)
    items = r.order_items
    arrived, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        stream = spark.readStream.schema(items.schema).parquet(arrived)
        guard_arriving_items(stream, lambda: r.products, out, progress).awaitTermination()

    half = F.col("quantity") > 25
    items.filter(half).write.parquet(arrived)
    run()
    items.filter(~half).write.mode("append").parquet(arrived)
    run()
    accepted = spark.read.parquet(f"{out}/accepted")
    rejected = spark.read.parquet(f"{out}/rejected")
    assert accepted.count() + rejected.count() == items.count()
    assert rejected.filter("stock >= quantity").isEmpty() and accepted.filter("stock < quantity").isEmpty()
    assert {r["batch"] for r in accepted.select("batch").distinct().collect()} == {0, 1}


def test_timings(spark, t):
    rows = timed_queries(spark, {"stores": lambda: t["stores"]}, runs=2).collect()
    assert [(r["query"], r["run"], r["n_rows"]) for r in rows] == [("stores", 1, 5), ("stores", 2, 5)]


def test_filters_reach_the_scan(spark):
    r = Retail(spark, FOLDER)
    assert "EqualTo(o_custkey,5)" in explain_query(relational.orders_of(r.orders, 5))
    month = explain_query(reports.sales_report(r.orders, 5, 1998))
    assert "GreaterThanOrEqual(o_orderdate,1998-05-01T00:00)" in month and "LessThan(o_orderdate,1998-06-01T00:00)" in month
    assert "GreaterThanOrEqual(o_orderdate,2001-02-01T00:00)" in explain_query(QUERIES["filter_recent"](spark, FOLDER))
    ilike = explain_query(relational.matching(r.products, "name", "%ring%", True))
    assert "StringContains" not in ilike and "IsNotNull(p_name)" in ilike


    function = QUERIES["sales_report_function"](spark, FOLDER)
    assert "GreaterThanOrEqual(o_orderdate,1998-05-01T00:00)" in explain_query(function)
    run = explain_run(lambda: relational.orders_of(r.orders, 5))
    assert f"actual rows: {relational.orders_of(r.orders, 5).count()}" in run and "FileScan" not in run.split("actual")[1]


def test_scans_read_few_columns(spark):
    plan = explain_query(QUERIES["store_revenue"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = explain_query(QUERIES["top_selling_products"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


@pytest.mark.parametrize("name", ["join_inner", "join_left", "join_full", "stock_guard", "store_revenue", "union_people",
                                  "pivot_months_crosstab", "join_outer_stale", "check_all_rules", "update_customer"])
def test_no_python_and_no_cross_join(spark, name):
    plan = explain_query(QUERIES[name](spark, FOLDER))
    for word in ("Python", "Cartesian", "BroadcastNestedLoop", "Scan ExistingRDD"):
        assert word not in plan


def test_one_scan_for_both_branches(spark):
    assert explain_query(QUERIES["union_active_inactive"](spark, FOLDER), "simple").count("FileScan") == 1


def test_nulls_sort_as_in_the_database(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "order_id int, order_date int")
    from tillmark.functions.ordering import falling, rising
    assert [r[0] for r in df.orderBy(falling("order_date")).collect()] == [1, 3, 2]
    assert [r[0] for r in df.orderBy(rising("order_date")).collect()] == [2, 3, 1]


def test_settings_grow_with_the_input():
    small, large = session.settings_for(10**9, 8), session.settings_for(10**14, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert 90_000 < int(large["spark.sql.shuffle.partitions"]) < 100_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 1024 * 1024 * 1024


def test_shared_folder_follows_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    written = session.materialize(spark.range(3).toDF("x"))
    assert session.shared_folder(spark) in written.inputFiles()[0]
