"""Compare a Spark result with a DuckDB result: columns, row count and every value."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def as_bag(rows, columns, order) -> Counter:
    places = [columns.index(c) for c in order]
    return Counter(tuple(plain(row[i]) for i in places) for row in rows)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def difference(result, connection, text: str) -> str | None:
    """None if both agree, else what differs."""
    relation = connection.sql(text)
    names = list(relation.columns)
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    types = dict(zip(names, map(str, relation.types)))
    for name, kind in result.dtypes:
        if TYPES.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    order = sorted(names)
    ours = as_bag([tuple(r) for r in result.collect()], result.columns, order)
    theirs = as_bag(relation.fetchall(), names, order)
    if ours == theirs:
        return None
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"missing {list(missing)[:2]}, extra {list(extra)[:2]} of {order}"
    )
