"""Compare a Spark result with a DuckDB result: names, types and the bag of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "decimal(3,1)": "DECIMAL(3,1)",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def bag(rows, positions) -> Counter:
    return Counter(tuple(plain(row[p]) for p in positions) for row in rows)


def assert_same(df: DataFrame, db: duckdb.DuckDBPyConnection, statement: str) -> int:
    cursor = db.execute(statement)
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = list(types)
    assert sorted(df.columns) == sorted(names)
    assert {n: SQL_TYPES[t] for n, t in df.dtypes} == types
    expected = bag(cursor.fetchall(), [names.index(c) for c in df.columns])
    found = bag(df.collect(), range(len(names)))
    assert found == expected, f"only Spark {list((found - expected).items())[:3]}, only SQL {list((expected - found).items())[:3]}"
    return sum(found.values())
