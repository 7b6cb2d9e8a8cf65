"""Compare a Spark result with a SQL result, ignoring row and column order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def _sorted_rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree in columns, types and rows; else what differs."""
    mine = _sorted_rows(df.columns, df.collect())
    cursor = connection.execute(sql)
    theirs = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1], strict=True):
        if repr(a) != repr(b):
            unequal = [(n, x, y) for n, x, y in zip(mine[0], a, b, strict=True) if repr(x) != repr(y)]
            return f"{str(unequal)[:600]}"
    return None
