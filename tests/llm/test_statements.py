"""Every query with a statement gives the rows DuckDB gives, and all queries run on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from compare import assert_same

from gradewell.llm.queries import QUERIES
from gradewell.llm.statements import STATEMENTS

TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@pytest.fixture(scope="module")
def db(small_folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, small_folder, db, name):
    assert assert_same(QUERIES[name](spark, small_folder), db, STATEMENTS[name]) > 0


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
