"""Tables kept by student: what is moved on the way, and that rows do not depend on it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.operators.skew import join_spread
from gradewell.plans.warehouse import LAYERS, SPREAD_BY_ALL_KEYS, Warehouse
from gradewell.session import setting
from test_random_data import random_module, random_students

TABLES = ["stg_students_clean", "dim_students", "stg_students_with_credits", "dim_students_with_credits", "fact_kpi"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def opened(spark, tmp_path_factory):
    """Warehouses over the same records: no student is hot; the large ones are."""
    folder = tmp_path_factory.mktemp("layout")
    spark.createDataFrame(random_students(5), t.STUDENTS).write.parquet(f"{folder}/students")
    spark.createDataFrame(random_module(5), t.MODULE).write.parquet(f"{folder}/module")
    raw = {n: (lambda n=n: spark.read.parquet(f"{folder}/{n}")) for n in ("students", "module")}
    return [Warehouse(spark, raw, f"{folder}/{rows}", rows, scans=("students",), buckets=3) for rows in (500_000, 20)]


def test_hot_students_are_not_kept_in_one_bucket(opened):
    assert [w.by_student("stg_students_clean") for w in opened] == [True, False]


@pytest.mark.parametrize("name", TABLES)
def test_rows_do_not_depend_on_the_layout(opened, name):
    plain, spread = (w.ref(name) for w in opened)
    assert plain.columns == spread.columns and plain.count() > 0 and same(plain, spread)


def test_attempts_are_moved_to_their_student_once(spark, opened):
    """After the cleaned table neither the dimension nor the credits move anything but one row a student or less."""
    w = opened[0]
    w.ref("stg_students_with_credits")
    with setting(spark, SPREAD_BY_ALL_KEYS, "false"):
        assert "Exchange hashpartitioning(student_id" not in plan(LAYERS["dim_students"](w))
        assert "Exchange hashpartitioning(student_id" not in plan(LAYERS["stg_students_with_credits"](w))
    assert spark.conf.get(SPREAD_BY_ALL_KEYS, "true") == "true"


def test_settings_come_back(spark):
    with pytest.raises(KeyError), setting(spark, SPREAD_BY_ALL_KEYS, "false"):
        raise KeyError
    assert spark.conf.get(SPREAD_BY_ALL_KEYS, "true") == "true"


def test_spread_join_without_hot_keys_is_plain(spark):
    rows = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 7).alias("k"))
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    none, some = (spark.createDataFrame(x, "k bigint, splits int") for x in ([], [(1, 3)]))
    for how in ("inner", "left"):
        expected = rows.join(lookup, "k", how)
        assert all(same(expected, join_spread(rows, lookup, ["k"], hot, "row_id", how)) for hot in (none, some))
    assert "_split" not in plan(join_spread(rows, lookup, ["k"], none, "row_id"))
    assert "_split" in plan(join_spread(rows, lookup, ["k"], some, "row_id"))


def test_progress_and_summary_read_the_fact_where_it_lies(opened):
    """The fact is kept by student as well; only with a hot student is it moved for them."""
    lying, plain = opened
    for w, moved in ((lying, False), (plain, True)):
        w.ref("fact_kpi")
        for name in ("study_progress_rows", "student_summary"):
            assert ("Exchange hashpartitioning(student_id" in plan(LAYERS[name](w))) is moved, name
