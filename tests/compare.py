"""Row-set comparison of a Spark result with a DuckDB statement."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else round(value, 9) if math.isfinite(value) else str(value)
    return value


def _row_key(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def rows_by_name(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_row_key)


def differences(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, value types and rows agree, else the first difference."""
    result = connection.execute(sql)
    wanted_names, wanted = rows_by_name([d[0] for d in result.description], result.fetchall())
    names, rows = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(rows) != len(wanted):
        missing = [r for r in wanted if r not in set(rows)][:2]
        extra = [r for r in rows if r not in set(wanted)][:2]
        return f"{len(rows)} rows != {len(wanted)}; missing {missing}; extra {extra}"
    for mine, theirs in zip(rows, wanted):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            diff = {n: (a, b) for n, a, b in zip(names, mine, theirs) if a != b or type(a) is not type(b)}
            return f"row differs: {diff}"
    return None
