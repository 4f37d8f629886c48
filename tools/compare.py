"""Order-insensitive comparison of a Spark result with a DuckDB result (both as Arrow tables)."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(table) -> Counter:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return Counter(tuple(_norm(x) for x in row) for row in zip(*data))


def types_of(table) -> dict:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(spark_table, oracle_table) -> list[str]:
    """Empty when both results hold the same columns, types and multiset of rows."""
    issues = []
    if sorted(spark_table.column_names) != sorted(oracle_table.column_names):
        return [f"columns spark={sorted(spark_table.column_names)} oracle={sorted(oracle_table.column_names)}"]
    ts, to = types_of(spark_table), types_of(oracle_table)
    diff = {c: (ts[c], to[c]) for c in ts if ts[c] != to[c]}
    if diff:
        issues.append(f"types {diff}")
    if spark_table.num_rows != oracle_table.num_rows:
        issues.append(f"rows spark={spark_table.num_rows} oracle={oracle_table.num_rows}")
    rs, ro = rows_of(spark_table), rows_of(oracle_table)
    if rs != ro:
        issues.append(f"values differ; spark-only {list((rs - ro).items())[:3]} "
                      f"oracle-only {list((ro - rs).items())[:3]}")
    return issues
