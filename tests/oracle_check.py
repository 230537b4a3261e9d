"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    left = _bag(df.columns, [tuple(r) for r in df.collect()])
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    right = _bag(names, out.fetchall())
    assert sorted(df.columns) == sorted(names), (name, df.columns, names)
    missing, extra = right - left, left - right
    assert not missing and not extra, (
        f"{name}: {sum(left.values())} rows against {sum(right.values())}; "
        f"only in SQL {list(missing.items())[:3]}; only in Spark {list(extra.items())[:3]}"
    )
    return sum(left.values())
