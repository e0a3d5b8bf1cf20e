"""Run a query in Spark and its SQL in DuckDB, and compare whole results."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# DuckDB column types and the Spark types they must stand against.
SAME_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _ordered(names, rows):
    """Rows with their columns in name order, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(frame, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    types = {d[0]: SAME_TYPE.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    if dict(frame.dtypes) != types:
        return [f"columns {sorted(set(frame.dtypes) ^ set(types.items()))}"]
    got = _ordered(frame.columns, [tuple(r) for r in frame.collect()])
    want = _ordered(list(types), expected)
    found = [] if len(got) == len(want) else [f"{len(got)} rows instead of {len(want)}"]
    return found + [f"{g}\n  instead of\n{w}" for g, w in zip(got, want) if g != w][:3]
