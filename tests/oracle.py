"""Run a query and its SQL twin, and compare columns, types and rows."""

from __future__ import annotations

import datetime as dt
import math
import os
import re

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}
WHOLE = {"BIGINT", "INTEGER"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if v is None else str(v)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(names)}"
    if sorted({c.lower() for c in names}) != sorted(c.lower() for c in names):
        return f"duplicate columns {names}"
    kinds = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    for c, k in df.dtypes:
        mine, other = KINDS.get(k, k), kinds[c]
        if mine != other:
            return f"type of {c}: spark {k} sql {other}"
    order = sorted(names)
    have = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    at = [names.index(c) for c in order]
    want = [tuple(_plain(r[i]) for i in at) for r in want]
    if len(have) != len(want):
        return f"rows: spark {len(have)} sql {len(want)}"
    # an ORDER BY after the last bracket and table is the result's own order
    if not re.search(r"(?i)\bORDER BY\b[^()]*$", sql):
        key = lambda r: tuple((v is None, v or "") for v in r)
        have.sort(key=key)
        want.sort(key=key)
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    if bad:
        return f"{len(bad)} of {len(have)} rows differ, e.g.\n  {order}\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    return None
