"""A query's rows beside its SQL's, in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def same(df, sql: str, con) -> tuple[bool, str]:
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {df.columns} {names}"
    bad = next(((a, b) for a, b in zip(got, want) if a != b), None)
    return got == want, f"{len(got)} {len(want)} {bad}"
