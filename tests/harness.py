"""Run a registered query and its SQL side by side and list the differences."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

from caseloom.checks.fixtures import BASE_TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "FLOAT": "float", "TIMESTAMP": "timestamp", "DATE": "date", "BOOLEAN": "boolean",
}


def differences(df, con, sql: str) -> list[str]:
    order = sorted(df.columns)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    theirs_raw = result.fetchall()
    if sorted(names) != order:
        return [f"columns differ: {sorted(set(names) ^ set(order))}"]
    found = []
    for name, kind in df.dtypes:
        if KINDS.get(types[name], types[name]) != kind.replace("timestamp_ntz", "timestamp"):
            found.append(f"type of {name}: {kind} against {types[name]}")
    at = [names.index(c) for c in order]
    ours = sorted(
        (tuple(plain(row[c]) for c in order) for row in df.collect()), key=repr
    )
    theirs = sorted((tuple(plain(row[i]) for i in at) for row in theirs_raw), key=repr)
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(order, a, b) if x != y]
        found.append(f"{len(wrong)} rows differ, first in {cells[:4]}")
    return found
