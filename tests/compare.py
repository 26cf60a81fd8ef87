"""Row-by-row comparison of the registered queries with their SQL counterparts."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs in column names, types, row counts or values; empty when all agree."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    want = rows_of(columns, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        other = {d[0]: str(d[1]).lower() for d in cursor.description}
        same = {"string": "varchar", "int": "integer"}
        return [f"type of {c}: {t} != {other[c]}" for c, t in types.items() if same.get(t, t) != other[c]]
    extra, lost = got - want, want - got
    return [
        f"{sum(got.values())} rows, {sum(want.values())} expected",
        f"not expected ({sum(extra.values())}): {str(list(extra)[:2])[:900]}",
        f"not found ({sum(lost.values())}): {str(list(lost)[:2])[:900]}",
    ]
