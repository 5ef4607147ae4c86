"""Side-by-side comparison of a Spark result and its SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2 ** 53 else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types)))
    kinds = [f"{c}: {t} != {theirs[c]}" for c, t in df.dtypes if KINDS.get(t, t) != theirs[c]]
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    other = canonical(relation.columns, relation.fetchall())
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{sorted(df.columns)}: {a} != {b}"
    if not mine:
        return "both empty"
    return f"types {kinds}" if kinds else None
