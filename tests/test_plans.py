"""Shape of the physical plans: what must and must not appear."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from gradewell.operators import cleaning, enrichment

WRITING = ("write_table", "seed_module", "create_or_replace_table")
NAMES = [n for n in entry.queries() if n not in WRITING and n not in entry.training_text()[0]]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_and_no_product(spark, small_folder, name):
    text = plan(entry.queries()[name](spark, small_folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas|Arrow", text)


def test_filter_and_columns_reach_the_scan(small):
    text = plan(cleaning.filter_main_grades(small.ref("students")).select("attempt_id"))
    assert "StringContains(Modul,APL)" in text
    assert "ReadSchema: struct<attempt_id:bigint,Modul:string>" in text


def test_kpi_reads_only_its_columns(small):
    text = plan(small.ref("module_boxplot_kpi"))
    assert "ReadSchema: struct<module_id:string,grade_numeric:double>" in text


def test_attempts_never_enter_a_window(small):
    """Windows of the enrichment sort cells; the attempts only meet a join."""
    rows = enrichment.stg_students_with_credits(small.ref("stg_students_clean"), small.ref("dim_students"), small.ref("dim_modul"))
    text = plan(rows)
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and not any("grade_numeric" in line for line in windows)
    assert "SortMergeJoin" in text


def test_fact_joins_are_broadcast(small):
    from gradewell.operators.fact import fact_kpi

    text = plan(fact_kpi(small.ref("stg_students_with_credits"), small.ref("dim_modul"), small.ref("dim_zeit")))
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_aggregates_combine_before_the_shuffle(small):
    text = plan(cleaning.student_profile(cleaning.clean_rows(small.ref("students"))))
    assert "partial_bit_or" in text
