"""Side-by-side run of a registered query and its oracle SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def both(spark, connection, build, sql: str, folder: str):
    """((columns, rows) of Spark, the same of the oracle)."""
    frame = build(spark, folder)
    ours = (sorted(frame.columns), rows_of(frame.columns, frame.collect()))
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    return ours, (sorted(names), rows_of(names, result.fetchall()))
