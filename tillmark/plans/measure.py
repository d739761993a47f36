"""Timing and plans of queries."""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Build = Callable[[], DataFrame]


def timed_run(build: Build) -> tuple[float, int]:
    """Seconds to build and run a query into the noop sink, and its rows, counted in the same run."""
    seen = Observation()
    start = time.perf_counter()
    build().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    return seconds, seen.get["rows"]


def timed_queries(spark: SparkSession, builds: Mapping[str, Build], runs: int = 1, echo: bool = False) -> DataFrame:
    """``query``, ``run``, ``seconds``, ``n_rows`` of each named query; ``echo`` also prints them."""
    rows = []
    for name, build in builds.items():
        for run in range(1, runs + 1):
            seconds, count = timed_run(build)
            if echo:
                print(f"{name}: {count} rows in {seconds:.6f} seconds")
            rows.append((name, run, seconds, count))
    return spark.createDataFrame(rows, "query string, run int, seconds double, n_rows bigint")


def explain_query(df: DataFrame, mode: str = "formatted") -> str:
    """The plan of a query as text, to see which filters reach the scan."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def explain_run(build: Build) -> str:
    """The plan of a query, then its actual rows and seconds from one run into the noop sink."""
    plan = explain_query(build())
    seconds, rows = timed_run(build)
    return f"{plan}\nactual rows: {rows}\nexecution seconds: {seconds:.6f}\n"
