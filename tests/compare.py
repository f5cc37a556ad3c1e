"""Compares a query's rows with those of its SQL twin."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        if name in TABLES:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def check(frame, connection, sql: str) -> list[str]:
    """Differences, empty if the results are the same to the last bit."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    actual = frame.collect()
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} instead of {sorted(names)}"]
    ours, theirs = canonical(frame.columns, actual), canonical(names, expected)
    problems = []
    if ours != theirs:
        problems.append(f"{sum(ours.values())} rows instead of {sum(theirs.values())}")
        problems += [f"only ours:   {row}"[:400] for row in list(ours - theirs)[:2]]
        problems += [f"only theirs: {row}"[:400] for row in list(theirs - ours)[:2]]
        problems.append(str(sorted(names)))
    kinds = dict(frame.dtypes)
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for column in cursor.description:
        if same.get(kinds[column[0]]) != str(column[1]):
            problems.append(f"type of {column[0]}: {kinds[column[0]]} and {column[1]}")
    return problems
