"""Compare a query's rows with its SQL equivalent in DuckDB."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # -0.0 -> 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple(str((v is None, v)) for v in r))


def differences(df, con, sql: str, show: int = 3) -> list[str]:
    """Human-readable differences; empty if names, types, counts and values agree."""
    got_columns = df.columns
    got = df.collect()
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return [f"columns {sorted(got_columns)} != {sorted(want_columns)}"]
    problems = []
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kinds.get(kind, kind) != want_types[name]:
            problems.append(f"type of {name}: {kind} != {want_types[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(a)} rows differ ({sorted(got_columns)})")
        problems += [f"  spark {x}\n  sql   {y}" for x, y in bad[:show]]
    return problems
