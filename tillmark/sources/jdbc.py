"""A database as a source, read in parallel ranges of a number column.

Needs a JDBC driver jar on the class path. The address comes from the standard client variables
(PGHOST, PGPORT, PGDATABASE, PGUSER, PGPASSWORD).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(table: str, partition_column: str, lower: int, upper: int, partitions: int,
                 environment: Mapping[str, str] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options: ``partitions`` tasks, each a range of ``partition_column``."""
    env = os.environ if environment is None else environment
    return {
        "url": f"jdbc:postgresql://{env.get('PGHOST', 'localhost')}:{env.get('PGPORT', '5432')}/{env['PGDATABASE']}",
        "driver": "org.postgresql.Driver",
        "user": env["PGUSER"],
        "password": env["PGPASSWORD"],
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def scan_jdbc(spark: SparkSession, table: str, partition_column: str, lower: int, upper: int,
              partitions: int) -> DataFrame:
    """Read a database table; bounds only split the work, rows outside them are read too."""
    options = jdbc_options(table, partition_column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options).load()
