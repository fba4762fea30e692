"""Comparison of a query with its SQL, as sets of rows with repeats."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{at}')")
    return con


def value(x):
    if isinstance(x, float):
        return round(x, 9) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return tuple(map(value, x)) if isinstance(x, list) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(value(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """Columns, and rows that only one side has."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    want = rows_of([d[0] for d in found.description], found.fetchall())
    return got[0], want[0], list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3]
