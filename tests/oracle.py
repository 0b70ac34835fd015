"""Compares queries with their SQL in DuckDB, rows as multisets."""

import math
from pathlib import Path

import duckdb


def connect(folder):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


def compare(spark, folder, query, sql, db):
    got = query(spark, str(folder))
    have = rows(got.columns, [tuple(r) for r in got.collect()])
    found = db.execute(sql)
    want = rows([c[0] for c in found.description], found.fetchall())
    assert have[0] == want[0]
    assert len(have[1]) == len(want[1]), (len(have[1]), len(want[1]), have[1][:3], want[1][:3])
    wrong = [(a, b) for a, b in zip(*[x[1] for x in (have, want)], strict=True) if a != b]
    assert not wrong, (len(wrong), wrong[:3])
