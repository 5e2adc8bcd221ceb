"""Compares a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else "inf" if math.isinf(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in got.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def assert_same(df, sf_dir: str, sql: str) -> int:
    a, b = spark_rows(df), sql_rows(sf_dir, sql)
    assert a[0] == b[0], (a[0], b[0])
    extra, missing = a[1] - b[1], b[1] - a[1]
    assert not extra and not missing, (len(extra), len(missing), list(extra)[:3], list(missing)[:3])
    return sum(a[1].values())
