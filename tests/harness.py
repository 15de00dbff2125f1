"""Run a registered query on Spark and its SQL on DuckDB and compare every value."""

from __future__ import annotations

import os
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _value(v):
    if hasattr(v, "asDict"):
        return tuple(_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _value(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    if isinstance(v, float):
        return "nan" if v != v else (0.0 if v == 0 else v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    got_names = spark_df.columns
    got = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got:
        return "no rows"
    for i, n in enumerate(got_names):
        a = {type(r[i]) for r in got} - {type(None)}
        b = {type(r[want_names.index(n)]) for r in want} - {type(None)}
        if a != b and not ({t.__name__ for t in a} <= {"Row", "tuple", "dict", "list"}):
            return f"type of {n}: {a} != {b}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    if a != b:
        left, right = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"{sum((a - b).values())} rows differ in {sorted(got_names)}:\n  spark {left}\n  duck  {right}"
    return None
