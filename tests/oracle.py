"""Side-by-side comparison of a query and its SQL on one data folder."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(r[i]) for i in order) for r in records)


def compare(frame, connection, sql: str) -> str:
    """Empty text if both sides agree, else what differs first."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected_names, expected = rows_of(names, answer.fetchall())
    found_names, found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if found_names != expected_names:
        return f"columns {found_names} != {expected_names}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    for mine, theirs in zip(found, expected):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return ""
