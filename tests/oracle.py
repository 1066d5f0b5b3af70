"""Compare a query with its SQL, row by row and regardless of order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(connection, sql: str, df) -> str | None:
    """None when both sides agree, otherwise what differs first."""
    cursor = connection.execute(sql)
    expected_columns, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    columns, rows = _rows(df.columns, [tuple(row) for row in df.collect()])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}; only here {_extra(rows, expected)}, only in SQL {_extra(expected, rows)}"
    for row, other in zip(rows, expected):
        if row != other or [type(a) for a in row] != [type(b) for b in other]:
            return f"{row} != {other}"
    return None


def _extra(left, right):
    return list(set(left) - set(right))[:3]
