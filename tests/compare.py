"""Compare a Spark result with DuckDB's over the same Parquet files."""

from __future__ import annotations

import collections
import datetime as dt
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns, types and rows agree; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    same = {"bigint": "bigint", "int": "integer", "string": "varchar", "date": "date", "timestamp_ntz": "timestamp"}
    for name, kind in spark_df.dtypes:
        if same.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    place = [names.index(c) for c in sorted(names)]
    theirs = collections.Counter(tuple(plain(row[i]) for i in place) for row in result.fetchall())
    ours = collections.Counter(tuple(plain(row[c]) for c in sorted(names)) for row in spark_df.collect())
    if ours == theirs:
        return None
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; only here {list((ours - theirs).items())[:3]}; "
            f"only there {list((theirs - ours).items())[:3]}")
