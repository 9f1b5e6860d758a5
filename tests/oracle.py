"""Compare a Spark result with the DuckDB result of its SQL twin, without row order."""

from __future__ import annotations

import math
import os

import duckdb

from millrace.plans.registry import TABLES

# with EXACT=1 doubles must agree to the last bit
EXACT = os.environ.get("EXACT") == "1"

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "binary": "BLOB",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if EXACT else f"{value + 0.0:.10g}"
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; none when names, types and rows agree."""
    out = []
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field, kind in df.dtypes:
        mapped = SPARK_TO_DUCK.get(kind, kind.upper())
        if mapped != types[field]:
            out.append(f"type of {field}: spark {kind}, duckdb {types[field]}")
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        out.append(f"row count {len(a)} != {len(b)}")
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        out.append(f"columns {sorted(names)}\n  spark  {only_a}\n  duckdb {only_b}")
    if not got:
        out.append("no rows")
    return out
