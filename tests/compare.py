"""Run a query in Spark and its SQL in DuckDB and compare the rows, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return int(x)
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        return round(x, 6) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(_cell(v) for v in x)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    types = [(type(a).__name__, type(b).__name__) for g, w in zip(got[:1], want[:1]) for a, b in zip(g, w) if a is not None and b is not None and type(a) is not type(b)]
    for g, w in zip(got, want):
        if g != w and not all(_near(a, b) for a, b in zip(g, w)):
            return f"{g} != {w}"
    return f"types differ {types}" if types else None


def _near(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 2e-6 * max(1.0, abs(b))
    return a == b
