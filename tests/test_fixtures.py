"""What the lines of orders take along while they become attempts."""

from __future__ import annotations

import datetime
import random

from gradewell.sources import fixtures


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def order_tables(spark):
    """Orders whose lines come twice or tie up to a late column, lines without an order or part, nulls in every column."""
    rng = random.Random(7)
    some = lambda *values: rng.choice([*values, None])
    day = lambda: some(datetime.date(1995, rng.randint(1, 12), 3), datetime.date(1997, 7, 1))
    lines = [
        (some(1, 2, 3, 4, 99), some(1, 2, 3, 99), some(1, 2), some(1, 2), some(*map(float, range(1, 51))), some(1.5, 2.5), some(0.0, 0.05, 0.1),
         some(0.0, 0.01, 0.02, 0.04), some("R", "A"), some("F", "O"), day())
        for _ in range(120)
    ]
    lineitem = spark.createDataFrame(
        lines + lines[:20],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
        " l_tax double, l_returnflag string, l_linestatus string, l_shipdate date",
    )
    orders = spark.createDataFrame([(k, some(10, 20), day()) for k in (1, 2, 3, 4, 5, None)], "o_orderkey bigint, o_custkey bigint, o_orderdate date")
    part = spark.createDataFrame(
        [(k, some(11, 44, 45, 48, 50), some("Brand#11", "Brand#23")) for k in (1, 2, 3, 3, None)], "p_partkey bigint, p_size int, p_brand string"
    )
    return lineitem, orders, part


def test_lines_take_little_to_their_part(spark):
    """The same attempts in a given number of partitions; what only orders the lines of an order ends before the second move."""
    tables = order_tables(spark)
    plain, given = fixtures.derive_students(*tables), fixtures.derive_students(*tables, 3)
    assert plain.count() > 50 and same(plain, given)
    text = given._jdf.queryExecution().optimizedPlan().toString()
    moved = text[text.index("RepartitionByExpression [l_partkey") :].splitlines()[1]
    assert "Note" in moved and "l_returnflag" not in moved and "disc" not in moved
