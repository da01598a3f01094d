"""Compare a registered query with its SQL counterpart."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(tidy, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both hold the same rows, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    want_names, want = _sorted(names, found.fetchall())
    have_names, have = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if want_names != have_names:
        return f"columns {have_names} != {want_names}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if spark_kinds.get(t, t) != kinds[c]]
    if wrong:
        return f"types {wrong}"
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}"
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    return f"{len(bad)} of {len(have)} rows differ, first {bad[0]}" if bad else None
