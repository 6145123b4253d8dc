"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def assert_same(frame, connection, sql: str) -> int:
    relation = connection.sql(sql)
    assert sorted(frame.columns) == sorted(relation.columns)
    ours = normal_rows(frame.columns, (tuple(r) for r in frame.collect()))
    theirs = normal_rows(relation.columns, relation.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert a == b
    return len(ours)
