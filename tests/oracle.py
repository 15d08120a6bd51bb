"""Runs a query in Spark and its SQL twin in DuckDB over the same files."""

from __future__ import annotations

import datetime as dt
import os

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


def both(spark, query, statement: str):
    """The rows of either side, sorted, with columns in order of name."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    found = query(spark, SF)
    result = con.execute(statement)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    order = sorted(names)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in found.collect()), key=repr)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    return mine, theirs
