"""Compare a Spark result with the SQL of the same query run by DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return f"{type(v).__name__}:{v}"


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    found = _table(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    cur = con.execute(sql)
    wanted = _table([d[0] for d in cur.description], cur.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if len(found[1]) != len(wanted[1]):
        return f"{len(found[1])} rows != {len(wanted[1])}"
    bad = [(a, b) for a, b in zip(found[1], wanted[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(found[1])} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return None
