"""Exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _normal(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, and rows as a multiset of exact values, agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} != {sorted(names)}"]
    mine = _normal(result.columns, [tuple(r) for r in result.collect()])
    theirs = _normal(names, expected)
    if mine == theirs:
        return []
    only_mine, only_theirs = mine - theirs, theirs - mine
    return [
        f"{sum(mine.values())} rows against {sum(theirs.values())}",
        f"only Spark ({sum(only_mine.values())}): {list(only_mine)[:3]}",
        f"only SQL ({sum(only_theirs.values())}): {list(only_theirs)[:3]}",
    ]
