"""Runs queries against their SQL in DuckDB: same columns, types and rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "bigint", "int": "integer", "string": "varchar", "double": "double", "boolean": "boolean", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}


def connect(sf: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return db


def plain(x):
    if isinstance(x, float):
        return 0.0 if x == 0 else None if math.isnan(x) else round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x


def compare(spark, sf: str, run, sql: str) -> str:
    """Empty if both agree, else what differs."""
    df = run(spark, sf)
    names = sorted(df.columns)
    got = sorted((plain(tuple(r)) for r in df.select(names).collect()), key=repr)
    answer = connect(sf).sql(sql)
    if sorted(answer.columns) != names:
        return f"columns {names} and {sorted(answer.columns)}"
    kinds = dict(zip(answer.columns, (str(t).lower() for t in answer.types)))
    for name, kind in df.dtypes:
        want = KINDS.get(kind.removeprefix("array<").removesuffix(">"), kind) + ("[]" if kind.startswith("array") else "")
        if kinds[name] != want:
            return f"{name} is {kind} and {kinds[name]}"
    at = [answer.columns.index(n) for n in names]
    want = sorted((plain(tuple(r[i] for i in at)) for r in answer.fetchall()), key=repr)
    if got != want:
        only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"{len(got)} and {len(want)} rows; only in Spark {str(only[0])[:600]}; only in SQL {str(only[1])[:600]}"
    return ""
