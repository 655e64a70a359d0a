"""Compare every query with its SQL, run by DuckDB on the same parquet files."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        if (Path(sf_dir) / f"{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, name, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    answer = connection.execute(sql)
    theirs = _rows([c[0] for c in answer.description], answer.fetchall())
    if mine[0] != theirs[0]:
        return f"{name}: columns {mine[0]} and {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{name}: {len(mine[1])} and {len(theirs[1])} rows"
    for left, right in zip(*(m[1] for m in (mine, theirs))):
        if left != right:
            return f"{name}: {dict(zip(mine[0], left))} and {dict(zip(mine[0], right))}"
    if not mine[1]:
        return f"{name}: no rows"
    return None
