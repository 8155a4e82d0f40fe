"""Compare a query with its SQL on the given tables."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"


def connection(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def assert_agrees(spark, query, text: str, folder: str = DATA) -> None:
    df = query(spark, folder)
    found = connection(folder).execute(text)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, found.fetchall())
