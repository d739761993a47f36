"""Table versions that share files: a change writes only the files that hold rows it touches.

A version is the folder ``base/name/version=...`` with the files it wrote (``data``) and the list of all files it is
made of (``files``, a table with one name per row). Files without a touched row are taken over from the version before
by name; they are neither read beyond their key column nor written. Older versions stay readable as long as their folders
do, and a folder may go when no later version lists a file of it.

Which files are touched is found from the key column alone: footers rule out those whose key range holds no touched key,
the others are matched by ``_metadata``. Only names of files reach the driver, one per file of the table. The version is
there when its list is: the list is written last.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.keyed import lookup_join, row_count, written

ROWS_PER_FILE = 1_000_000


def _folder(base: str, name: str, version: str) -> str:
    return f"{base}/{name}/version={version}"


def version_files(spark: SparkSession, name: str, base: str, version: str) -> list[str]:
    """The files that a version is made of."""
    listed = spark.read.schema("file string").parquet(f"{_folder(base, name, version)}/files")
    return sorted(row["file"] for row in listed.collect())


def read_version(spark: SparkSession, name: str, base: str, version: str, schema: T.StructType) -> DataFrame:
    """The rows of a version."""
    return spark.read.schema(schema).parquet(*version_files(spark, name, base, version))


def _seal(rows: DataFrame, kept: list[str], name: str, base: str, version: str) -> DataFrame:
    """Write the new files, then the list; the whole version, which the table's view shows from now on."""
    spark, folder = rows.sparkSession, _folder(base, name, version)
    rows.write.mode("errorifexists").parquet(f"{folder}/data")
    added = [unquote(f) for f in spark.read.schema(rows.schema).parquet(f"{folder}/data").inputFiles()]
    listed = spark.createDataFrame([(f,) for f in [*kept, *added]], "file string")
    listed.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/files")
    stored = read_version(spark, name, base, version, rows.schema)
    stored.createOrReplaceTempView(name)
    return stored


def publish_whole(state: DataFrame, name: str, base: str, version: str) -> DataFrame:
    """A version that consists of files of its own only."""
    return _seal(state, [], name, base, version)


def publish_changes(stored: DataFrame, name: str, base: str, version: str, key: str,
                    changed: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The version that follows ``stored`` (read from another one): rows of ``changed`` take the place of those with their
    key or, where there is none, are added; rows whose key is in ``gone`` are left out.

    A NULL key and a key that is changed twice are errors, since the result would not be defined; keys of ``gone`` may be
    unknown, repeated or NULL, and go also if they are changed. Without a change the new version lists the old files.
    """
    columns = stored.columns
    files = [unquote(f) for f in stored.inputFiles()]
    nothing = stored.limit(0)
    news = written((nothing if changed is None else changed).select(*columns), "changed")
    repeated = news.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull())
    if not repeated.isEmpty():
        raise ValueError(f"changes of {name} must name each {key} once, and none that is NULL")
    dropped = (nothing if gone is None else gone).select(F.col(key).alias("_touched")).filter("_touched IS NOT NULL").distinct()
    if gone is not None:
        dropped = written(dropped, "gone")
        news = written(lookup_join(news, dropped, key, "_touched", "left_anti", hot=None), "kept")
    touched = written(news.select(F.col(key).alias("_touched")).unionByName(dropped).distinct(), "touched")
    low, high = touched.agg(F.min("_touched"), F.max("_touched")).first()
    hit: set[str] = set()
    if low is not None:
        near = stored.filter(F.col(key).between(low, high)).select(key, F.col("_metadata.file_name").alias("_file"))
        found = lookup_join(near, touched, key, "_touched", "left_semi", hot=None).select("_file").distinct()
        hit = {row["_file"] for row in found.collect()}
    rewritten = [f for f in files if f.rsplit("/", 1)[-1] in hit]
    rows = news
    if rewritten:
        old = stored.sparkSession.read.schema(stored.schema).parquet(*rewritten)
        rows = lookup_join(old, touched, key, "_touched", "left_anti", hot=None).unionByName(news)
    most = max(1, len(rewritten) + row_count(news) // ROWS_PER_FILE)
    return _seal(rows.coalesce(most), [f for f in files if f.rsplit("/", 1)[-1] not in hit], name, base, version)
