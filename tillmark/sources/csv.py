"""CSV files with a header, and a session-scoped table on top of one.

Files whose quoted values hold line breaks are read in splits like others. A quote inside a value is doubled, so a line
break is inside a value exactly if the number of quotes before it in the file is odd. A first pass counts the quotes of
each split; from one small row per split follows whether a split begins inside a value. A second pass cuts the lines of
every split into records. What crosses the end of a split is put together from its pieces, at most two per split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.keyed import fits_broadcast, row_count, written
from tillmark.schema import SHIPMENTS


# Stands for NULL where a file has none of its own: no text holds it, so an empty value without quotes is NULL and
# a quoted one an empty text.
NO_TEXT = "\0"

RECORD, TAIL, MIDDLE, HEAD = range(4)  # a whole record, and the pieces of one that crosses splits


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, null_value: str = NO_TEXT,
             mode: str = "FAILFAST", line_breaks: bool = False) -> DataFrame:
    """Read CSV with a header. Without a schema the types are inferred, which reads the data twice.

    A quote inside a quoted value is doubled. ``mode`` is Spark's: by default a malformed row raises.
    ``line_breaks`` allows them inside quoted values, see ``quoted_records``; with inferred types each
    file is then read by one task.
    """
    options = {"header": "true", "escape": '"', "nullValue": null_value, "mode": mode}
    if schema is not None and line_breaks:
        return _parsed(spark, path, schema, options)
    reader = spark.read.options(**options).option("multiLine", line_breaks)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def scan_csv_text(spark: SparkSession, path: str, null_value: str = NO_TEXT, line_breaks: bool = True,
                  position: str | None = None) -> DataFrame:
    """Read CSV with a header as text columns.

    ``line_breaks`` allows them inside quoted values, see ``quoted_records``. ``position`` names a further
    column that sorts the rows by file and place in the file; it is there only with ``line_breaks``.
    """
    options = {"header": "true", "escape": '"', "nullValue": null_value}
    reader = spark.read.options(**options).option("multiLine", line_breaks)
    if not line_breaks:
        return reader.csv(path)
    return _parsed(spark, path, reader.csv(path).schema, options, position)  # the names take the first record only


def _parsed(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], position: str | None = None) -> DataFrame:
    records = quoted_records(spark, path)
    if records is None:
        place = [F.struct(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("start"),
                          F.monotonically_increasing_id().alias("n")).alias(position)] if position else []
        return spark.read.options(**options).option("multiLine", True).schema(schema).csv(path).select(
            *[F.col(f"`{c}`") for c in schema.names], *place)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", fields, options | {"multiLine": "true"}).alias("row")
    place = [F.struct("file", "start", "n").alias(position)] if position else []
    return records.select(parsed, *place).select("row.*", *([position] if position else []))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def quoted_records(spark: SparkSession, path: str) -> DataFrame | None:
    """file, start (of the split), n and record: the records of CSV files without their headers.

    Lines end with a line feed, or with carriage return and line feed; a value that holds a quote is quoted.
    Empty lines between records are passed over, as by Spark's reader. A task reads a split, never a whole file.
    None where more splits begin inside a value than can be sent to every task: so many files or breaks are left to
    Spark's own reader, a task per file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    odd = lines.groupBy("file", "start").agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = odd.select(F.col("file").alias("_file"), F.col("start").alias("_start"), (F.sum("odd").over(before) % 2).alias("_open"))
    inside = written(inside.filter("_open = 1"), "splits")
    if not fits_broadcast(inside):
        return None
    if row_count(inside):
        lines = lines.join(F.broadcast(inside), (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left")
    else:
        lines = lines.withColumn("_open", F.lit(0))
    cut = lines.select("value", "file", "start", F.coalesce("_open", F.lit(0)).cast("int").alias("open"),
                       F.xxhash64("file", "start").alias("split")).mapInPandas(
        _cut, "file string, start bigint, n bigint, kind int, record string")
    whole = cut.filter(F.col("kind") == RECORD).drop("kind")
    if not row_count(inside):
        return whole
    pieces = cut.filter(F.col("kind") != RECORD)
    order = Window.partitionBy("file").orderBy("start", "n")
    numbered = pieces.withColumn("no", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = numbered.groupBy("file", "no").agg(F.sort_array(F.collect_list(F.struct("start", "n", "record"))).alias("pieces"))
    crossing = joined.select(
        "file", F.col("pieces")[0]["start"].alias("start"), F.col("pieces")[0]["n"].alias("n"),
        F.regexp_replace(F.concat_ws("\n", F.col("pieces.record")), r"\r\z", "").alias("record"))
    return whole.unionByName(crossing)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records and pieces of the lines of a task, split by split; the first record of a file is its header."""
    split = None
    for batch in batches:
        ends = np.flatnonzero(np.diff(batch["split"].to_numpy())) + 1
        for low, high in zip([0, *ends], [*ends, len(batch)]):
            if low == high:
                continue
            first = batch.iloc[low]
            if split is None or first["split"] != split.key:
                if split is not None:
                    yield split.rows(last=True)
                split = _Split(first)
            split.add(batch["value"].iloc[low:high])
            yield split.rows(last=False)
    if split is not None:
        yield split.rows(last=True)


class _Split:
    """The lines of one split: what is cut, and the open record."""

    def __init__(self, first: pd.Series):
        self.key, self.file, self.start = first["split"], first["file"], int(first["start"])
        self.open = bool(first["open"])  # the next line goes on with a value
        self.kind = HEAD if self.open else RECORD
        self.header = self.start == 0
        self.pending: list[str] = []
        self.cut: list[tuple[int, int, str]] = []
        self.n = 0

    def add(self, lines: pd.Series) -> None:
        odd = (lines.str.count('"').to_numpy() % 2).astype(bool)
        for line, flips in zip(lines, odd):
            if flips:
                self.open = not self.open
            if self.open or self.pending:
                self.pending.append(line)
                if self.open:
                    continue
                line, self.pending = "\n".join(self.pending), []
            self._close(line, self.kind)
            self.kind = RECORD

    def _close(self, text: str, kind: int) -> None:
        if kind == RECORD:
            text = text.removesuffix("\r")
            if not text:
                return
            if self.header:
                self.header = False
                return
        self.cut.append((self.n, kind, text))
        self.n += 1

    def rows(self, last: bool) -> pd.DataFrame:
        if last and self.pending:  # it goes on in the next split, or the file ends inside a value
            self._close("\n".join(self.pending), MIDDLE if self.kind == HEAD else TAIL)
        cut, self.cut = self.cut, []
        held = {"file": [self.file] * len(cut), "start": [self.start] * len(cut), "n": [n for n, _, _ in cut],
                "kind": [k for _, k, _ in cut], "record": [r for _, _, r in cut]}
        return pd.DataFrame({c: pd.Series(v, dtype=object if c in ("file", "record") else "int64") for c, v in held.items()})


def shipments_table(spark: SparkSession, path: str, name: str = "temp_shipments") -> DataFrame:
    """Register a delivery list as a temporary table of the session."""
    scan_csv(spark, path, SHIPMENTS).createOrReplaceTempView(name)
    return spark.table(name)
