"""Spark results against DuckDB's on the same tables."""

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str = DATA):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(r[i]) for i in order) for r in rows])


def same(df, connection, sql: str) -> None:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = connection.execute(sql)
    want = rows_of([d[0] for d in found.description], found.fetchall())
    assert got == want
