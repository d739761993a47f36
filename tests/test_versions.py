"""Versions that share files."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tillmark.sinks.versions import publish_changes, publish_whole, read_version, version_files


def bytes_of(files):
    return {f: hashlib.sha256(open(f.removeprefix("file://").removeprefix("file:"), "rb").read()).hexdigest() for f in files}


@pytest.fixture()
def base(tmp_path):
    return str(tmp_path / "a shop=1 50%")


def stock(spark, base, rows=4000, files=8):
    made = spark.range(rows).select(F.col("id").alias("product_id"), F.concat(F.lit("n"), "id").alias("name"), F.lit(5).alias("stock"))
    return publish_whole(made.repartitionByRange(files, "product_id"), "stock", base, "1")


def test_only_files_with_touched_rows_are_written(spark, base):
    first = stock(spark, base)
    before = bytes_of(version_files(spark, "stock", base, "1"))
    changed = first.filter("product_id IN (10, 3999)").withColumn("stock", F.lit(9)).unionByName(
        spark.createDataFrame([(9000, "new", 1)], first.schema))
    second = publish_changes(first, "stock", base, "2", "product_id", changed, spark.createDataFrame([(11,), (11,), (None,), (-5,)], "product_id long"))
    rows = {r.product_id: (r.name, r.stock) for r in second.collect()}
    expected = {i: (f"n{i}", 9 if i in (10, 3999) else 5) for i in range(4000) if i != 11} | {9000: ("new", 1)}
    assert rows == expected and second.count() == len(expected)
    after = version_files(spark, "stock", base, "2")
    assert len(set(before) & set(after)) == 6 and bytes_of(before) == before  # two of eight ranges were touched
    written = sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in set(after) - set(before))
    assert written < 0.5 * sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in before)
    assert read_version(spark, "stock", base, "1", first.schema).filter("stock = 9").isEmpty()
    assert spark.table("stock").count() == len(expected)


def test_random_changes_in_a_row(spark, base):
    rng = random.Random(3)
    state, table = {i: (f"n{i}", 5) for i in range(300)}, stock(spark, base, 300, 5)
    for version in range(2, 6):
        keys = rng.sample(range(400), rng.choice([0, 1, 30]))
        gone = rng.sample(range(400), rng.choice([0, 1, 40]))
        changed = spark.createDataFrame([(k, f"v{version}", version) for k in keys], table.schema)
        table = publish_changes(table, "stock", base, str(version), "product_id", changed, spark.createDataFrame([(k,) for k in gone], "product_id long"))
        state = {k: v for k, v in (state | {k: (f"v{version}", version) for k in keys}).items() if k not in gone}
        assert {r.product_id: (r.name, r.stock) for r in table.collect()} == state


def test_appends_and_empty_changes_touch_no_file(spark, base):
    first = stock(spark, base)
    names = set(version_files(spark, "stock", base, "1"))
    more = spark.createDataFrame([(5000 + i, "x", 1) for i in range(10)], first.schema)
    second = publish_changes(first, "stock", base, "2", "product_id", more)
    assert names < set(version_files(spark, "stock", base, "2")) and second.count() == 4010
    third = publish_changes(second, "stock", base, "3", "product_id")
    assert names < set(version_files(spark, "stock", base, "3")) and third.count() == 4010


def test_undefined_changes_are_refused(spark, base):
    first = stock(spark, base, 10, 2)
    for rows in ([(1, "a", 1), (1, "b", 2)], [(None, "a", 1)]):
        with pytest.raises(ValueError, match="must name each"):
            publish_changes(first, "stock", base, "2", "product_id", spark.createDataFrame(rows, first.schema))
    publish_changes(first, "stock", base, "2", "product_id")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        publish_changes(first, "stock", base, "2", "product_id")
