"""Runs a registered query and its SQL side by side and compares the two row sets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value if value is None else str(value)


def row_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql, finished=None):
    """None when both agree, else a short text; notes the time the Spark side finished."""
    rows = [tuple(r) for r in df.collect()]
    if finished is not None:
        finished.append(time.time())
    theirs = con.execute(sql)
    names, expected = row_set([d[0] for d in theirs.description], theirs.fetchall())
    mine_names, mine = row_set(df.columns, rows)
    if names != mine_names:
        return f"columns {mine_names} vs {names}"
    if len(mine) != len(expected):
        return f"{len(mine)} rows vs {len(expected)}"
    if not mine:
        return "no rows"
    wrong = [(a, b) for a, b in zip(mine, expected) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None
