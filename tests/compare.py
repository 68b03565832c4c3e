"""Run a registered query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, name, build, sql, folder, connection) -> list[str]:
    frame = build(spark, folder)
    rows = [tuple(row) for row in frame.collect()]
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    found = []
    if sorted(names) != sorted(frame.columns):
        found.append(f"{name}: columns {sorted(frame.columns)} / {sorted(names)}")
        return found
    ours, theirs = _bag(frame.columns, rows), _bag(names, expected)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        found.append(
            f"{name}: {len(rows)} / {len(expected)} rows, only Spark {list(extra)[:2]}, "
            f"only SQL {list(missing)[:2]}"
        )
    types = [column[1] for column in cursor.description]
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }
    spark_types = dict(frame.dtypes)
    for column, kind in zip(names, types):
        if kinds.get(spark_types[column], "?") != str(kind):
            found.append(f"{name}.{column}: type {spark_types[column]} / {kind}")
    return found
