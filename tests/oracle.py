"""Holds a Spark result against DuckDB's over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql: str, sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    r = c.sql(sql)
    return r.columns, r.fetchall()


def plain(rows):
    f = lambda v: f"{v:.6g}" if isinstance(v, float) else repr(v)
    return sorted(tuple(f(v) for v in r) for r in rows)


def assert_same(df, sql: str, sf_dir: str):
    columns, want = rows_of(sql, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    got = plain([tuple(r[c] for c in order) for r in df.collect()])
    assert got == plain([tuple(r[columns.index(c)] for c in order) for r in want])
