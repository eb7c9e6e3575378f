"""Runs registered queries against their SQL counterparts in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return ("n", value.normalize())
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return ("f", repr(float(value))) if isinstance(value, float) else ("i", value)
    if isinstance(value, datetime.datetime):
        return ("t", value.isoformat())
    return (type(value).__name__, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=str)


def differences(spark, con, query, sql, sf_dir) -> str | None:
    """None if both sides give the same columns and the same rows in any order."""
    frame = query(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    ours, theirs = _rows(frame.columns, got), _rows(names, want)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
