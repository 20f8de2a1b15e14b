"""Every registered query against its DuckDB statement on the derived exam data."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import assert_same

OPTIONAL, OPTIONAL_STATEMENTS = entry.training_text()  # tested beside their subpackage, if it is there
QUERIES = {name: query for name, query in entry.queries().items() if name not in OPTIONAL}
STATEMENTS = {name: sql for name, sql in entry.oracle_sql().items() if name not in OPTIONAL_STATEMENTS}
EMPTY_ON_SMALL_DATA = {"module_finally_failed", "dq_single_credit_award"}


@pytest.fixture(scope="module")
def db(small_folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{small_folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small_folder, db, name):
    rows = assert_same(QUERIES[name](spark, small_folder), db, STATEMENTS[name])
    assert rows > 0 or name in EMPTY_ON_SMALL_DATA


def test_entry(spark, small_folder):
    assert entry.entry(spark).count() > 0
