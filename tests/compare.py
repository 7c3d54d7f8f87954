"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda position: names[position])
    return Counter(tuple(_plain(row[position]) for position in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """What differs between a Spark result and the SQL result, or None."""
    result = connection.execute(sql)
    sql_names = [column[0] for column in result.description]
    if sorted(frame.columns) != sorted(sql_names):
        return f"columns {sorted(set(frame.columns) ^ set(sql_names))}"
    sql_types = dict(zip(sql_names, (str(column[1]) for column in result.description)))
    expected = rows_of(sql_names, result.fetchall())
    found = rows_of(frame.columns, frame.collect())
    families = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {
        name: (kind, sql_types[name])
        for name, kind in frame.dtypes
        if families.get(kind, "TIMESTAMP") != sql_types[name]
    }
    if odd:
        return f"types {odd}"
    if expected == found:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"rows {sum(expected.values())} expected, {sum(found.values())} found; "
        f"columns {sorted(sql_names)}; missing {list(missing)[:2]}; extra {list(extra)[:2]}"
    )
