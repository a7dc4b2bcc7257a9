"""Compare a Spark result with a DuckDB result: names, kinds of types and every value."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(type_name: str) -> str:
    base = type_name.lower().split("(")[0]
    kinds = {
        "varchar": "string", "integer": "int", "timestamp_ntz": "timestamp", "timestamp with time zone": "timestamp",
    }
    return kinds.get(base, base)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    relation = con.sql(sql)
    ours, theirs = sorted(spark_df.columns), sorted(relation.columns)
    if ours != theirs:
        return [f"columns {ours} and {theirs}"]
    found = []
    spark_types = {name: _kind(kind) for name, kind in spark_df.dtypes}
    sql_types = {name: _kind(str(kind)) for name, kind in zip(relation.columns, relation.types)}
    for name in ours:
        if spark_types[name] != sql_types[name]:
            found.append(f"type of {name}: {spark_types[name]} and {sql_types[name]}")
    left = Counter(tuple(_plain(row[name]) for name in ours) for row in spark_df.collect())
    order = [relation.columns.index(name) for name in ours]
    right = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    if left.total() != right.total():
        found.append(f"rows {left.total()} and {right.total()}")
    if left != right:
        found.append(f"only Spark: {list((left - right).items())[:2]}; only SQL: {list((right - left).items())[:2]}")
    return found


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value
