"""Compares a Spark result with DuckDB's, the way the correctness gate does: sorted columns, row multiset."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    rel = con.sql(sql)
    out = []
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} != {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    known = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    }
    for name, kind in df.dtypes:
        if known.get(kind, kind) != kinds[name]:
            out.append(f"type of {name}: {kind} != {kinds[name]}")
    ours = _rows(df.columns, df.collect())
    theirs = _rows(rel.columns, rel.fetchall())
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first: {str(wrong[0][0])[:600]} != {str(wrong[0][1])[:600]}")
    return out
