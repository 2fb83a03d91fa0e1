"""Holds a query against its SQL, as bags of rows."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(df, con, sql) -> None:
    got = bag([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(sql)
    want = bag(res.fetchall(), [d[0] for d in res.description])
    assert sorted(df.columns) == sorted(d[0] for d in con.execute(sql).description)
    assert got == want
