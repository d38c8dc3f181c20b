"""Compare a Spark result with its SQL in DuckDB, without regard to row and column order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, (bool, int)):
        return str(int(v))
    return None if v is None else str(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        [tuple(_plain(r[i]) for i in order) for r in rows], key=lambda t: tuple((x is not None, x or "") for x in t)
    )


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return normalised([d[0] for d in cur.description], cur.fetchall())
