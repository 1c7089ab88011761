"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def connect(sf: str):
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v) if isinstance(v, float) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Problems found; empty when names, types, row count and values agree."""
    problems = []
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description}
    want = rows_of(want_names, cur.fetchall())
    got_types = dict(df.dtypes)
    if sorted(df.columns) != sorted(want_names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(want_names)}")
        return problems
    diff = {c: (got_types[c], want_types[c]) for c in want_names if got_types[c] != want_types[c]}
    if diff:
        problems.append(f"types (spark, sql): {diff}")
    got = rows_of(df.columns, df.collect())
    n, m = sum(got.values()), sum(want.values())
    if n != m:
        problems.append(f"rows {n} != {m}")
    if got != want:
        names = sorted(want_names)
        only_got, only_want = list((got - want).items())[:3], list((want - got).items())[:3]
        problems.append(
            f"values differ in {sum((got - want).values())} rows {names}\n"
            f"   spark {only_got}\n   sql   {only_want}"
        )
    return problems
