"""Both engines side by side over one scale factor."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9) + 0.0
    if hasattr(x, "as_tuple"):
        return round(float(x), 9)
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark_df, con, sql: str) -> str:
    """Empty if both have the same columns and rows."""
    a_names, a = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    b_names, b = rows([d[0] for d in cur.description], cur.fetchall())
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows; {a[:2]} {b[:2]}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{x} and {y}"
    return ""
