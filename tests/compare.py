"""Run queries beside their SQL and compare the results as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    start = time.time()
    frame = query(spark, sf_dir)
    got = frame.collect()
    spent = time.time() - start
    out = {"name": name, "rows": len(got), "seconds": round(spent, 2), "ok": None}
    if sql is None:
        return out
    cur = (con or database(sf_dir)).execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    have = rows_of(frame.columns, got)
    out["ok"] = sorted(columns) == sorted(frame.columns) and want == have
    if not out["ok"]:
        out["columns"] = (sorted(frame.columns), sorted(columns))
        out["only spark"] = list((have - want).items())[:3]
        out["only sql"] = list((want - have).items())[:3]
        out["sizes"] = (sum(have.values()), sum(want.values()))
    return out
