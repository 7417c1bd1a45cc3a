"""Compare a registered query with its SQL, as unordered rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql: str, sf: str) -> int:
    df = query(spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    want = _rows(relation.columns, relation.fetchall())
    assert sorted(df.columns) == sorted(relation.columns), (df.columns, relation.columns)
    assert len(got) == len(want), (len(got), len(want), got[:2], want[:2])
    for g, w in zip(got, want):
        assert g == w, (g, w)
    return len(got)
