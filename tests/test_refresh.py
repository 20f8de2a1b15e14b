"""Layers over a growing set of records, against full builds."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.plans.refresh import GrowingTables
from gradewell.plans.warehouse import KPIS, Warehouse
from test_random_data import random_module, random_students

TABLES = [
    "student_profile", "stg_students_clean", "dim_students", "stg_students_with_credits", "dim_zeit",
    "dim_students_with_credits", "fact_kpi",
]


def rows_of(frame) -> list:
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    spark.createDataFrame(random_students(3, 600), t.STUDENTS).write.parquet(f"{folder}/students")
    spark.createDataFrame(random_module(3), t.MODULE).write.parquet(f"{folder}/module")
    scores = spark.createDataFrame([(s, s % 2 == 0, 0.5, False, 0.7, "a", "b") for s in range(1, 30)], t.STUDENT_ML)
    return spark.read.parquet(f"{folder}/students"), lambda: spark.read.parquet(f"{folder}/module"), lambda: scores


def full(spark, raw, folder, students=None):
    records, module, scores = raw
    given = {"students": lambda: records if students is None else students, "module": module, "student_ml": scores}
    return Warehouse(spark, given, folder=str(folder), rows_per_task=20, scans=("students",))


def growing(spark, raw, folder, **options):
    return GrowingTables(spark, raw[1], str(folder), parts=8, rows_per_task=20, **options)


def files(folder, parts) -> dict:
    found = [f for p in parts for f in Path(folder).glob(f"*/part={p}/*.parquet")]
    return {str(f): f.stat().st_mtime_ns for f in found}


def test_appends_in_any_order_equal_a_full_build(spark, raw, tmp_path):
    """Late and early terms, new and known students; a batch handed in twice counts once."""
    records, tables = raw[0], growing(spark, raw, tmp_path / "grown")
    part = F.pmod(F.xxhash64("attempt_id"), F.lit(3))
    late = F.col("Jahr") >= 17
    tables.append(records.filter(late & (part == 0)), "a/1")
    tables.append(records.filter(~late & (part == 0)), "b")
    tables.append(records.filter(part != 0), "c")
    tables.append(records.filter(part != 0), "c")
    expected = full(spark, raw, tmp_path / "full")
    for name in TABLES:
        assert tables.ref(name).columns == expected.ref(name).columns
        assert rows_of(tables.ref(name)) == rows_of(expected.ref(name)), name
    opened = tables.warehouse(raw[2], str(tmp_path / "kpis"))
    for name in ("cohort_kpi", "studiengang_kpi", "student_kpi_ml", "study_progress_kpi", "modul_kpi"):
        assert name in KPIS and rows_of(opened.ref(name)) == rows_of(expected.ref(name)), name


def test_other_parts_keep_their_files(spark, raw, tmp_path):
    records, tables = raw[0], growing(spark, raw, tmp_path)
    tables.append(records.filter("attempt_id % 2 = 0"), "first")
    part = "CAST(pmod(xxhash64(studentID), 8) AS int)"
    mine = records.filter(f"studentID = 7 AND attempt_id % 2 = 1")
    touched = mine.selectExpr(part).first()[0]
    others = [p for p in range(8) if p != touched]
    kept, replaced = files(tmp_path, others), files(tmp_path, [touched])
    assert tables.append(mine, "second") == 1
    assert kept and files(tmp_path, others) == kept and not set(files(tmp_path, [touched])) & set(replaced)
    whole = records.filter("studentID = 7 OR attempt_id % 2 = 0")
    expected = full(spark, raw, tmp_path / "full", whole)
    assert rows_of(tables.ref("fact_kpi")) == rows_of(expected.ref("fact_kpi"))


def test_records_that_come_again_count_once(spark, raw, tmp_path):
    """Copies within a file, in later files and with other ids, through the stream."""
    from gradewell.plans.checks import dedupe_raw

    few = raw[0].filter("studentID % 5 < 3")
    arriving, tables = str(tmp_path / "in"), growing(spark, raw, tmp_path / "grown", once=True)
    copies = few.withColumn("attempt_id", F.col("attempt_id") + 10_000_000)
    for k, rows in enumerate([copies, few.union(few.withColumn("attempt_id", F.col("attempt_id") + 20_000_000))]):
        rows.coalesce(1).write.mode("append").parquet(arriving)
        tables.stream(arriving, str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/grown/students").count() == 3 * few.count()
    expected = full(spark, raw, tmp_path / "full", dedupe_raw(few).select(*t.STUDENTS.names))
    for name in ("students", "stg_students_clean", "fact_kpi"):
        assert rows_of(tables.ref(name)) == rows_of(expected.ref(name)), name


def test_nothing_has_arrived(spark, raw, tmp_path):
    tables = growing(spark, raw, tmp_path)
    assert tables.append(raw[0].limit(0), "empty") == 0
    assert all(tables.ref(name).count() == 0 for name in TABLES)
    undated = raw[0].limit(3).withColumn("Jahr", F.lit(None).cast("bigint"))
    assert tables.append(undated, "undated") > 0 and tables.ref("fact_kpi").count() == 0


@pytest.mark.parametrize("rows_per_task", [20, 10_000])  # students too large for a task, and none
def test_builds_by_student_equal_a_full_build(spark, raw, tmp_path, rows_per_task):
    """Attempts lie by student within their parts; parts without new records keep their files."""
    records, folder = raw[0], str(tmp_path / "it's grown")
    tables = GrowingTables(spark, raw[1], folder, parts=8, rows_per_task=rows_per_task, buckets=3)
    before = {c.name for c in spark.catalog.listTables()}
    tables.append(records.filter("attempt_id % 2 = 0"), "a/1")
    mine = records.filter("attempt_id % 2 = 1 AND studentID = 7")
    touched = mine.selectExpr("CAST(pmod(xxhash64(studentID), 8) AS int)").first()[0]
    others = [p for p in range(8) if p != touched]
    kept = files(folder, others)
    assert tables.append(mine, "b") == 1
    assert kept and files(folder, others) == kept
    # the same batch again, in another number of buckets
    assert GrowingTables(spark, raw[1], folder, parts=8, rows_per_task=rows_per_task, buckets=5).append(mine, "b") == 1
    assert {c.name for c in spark.catalog.listTables()} == before
    expected = full(spark, raw, tmp_path / "full", records.filter("attempt_id % 2 = 0 OR studentID = 7"))
    for name in TABLES:
        assert tables.ref(name).columns == expected.ref(name).columns
        assert rows_of(tables.ref(name)) == rows_of(expected.ref(name)), name


def test_a_build_moves_attempts_to_their_student_once(spark, raw, tmp_path, monkeypatch):
    from test_plans import plan

    plans, write = {}, GrowingTables._write_by_student

    def seen(self, name, table, rows):
        plans[name] = plan(self._parted(self._placed(rows)))
        return write(self, name, table, rows)

    monkeypatch.setattr(GrowingTables, "_write_by_student", seen)
    GrowingTables(spark, raw[1], str(tmp_path), parts=8, buckets=3).append(raw[0], "all")
    moved = {name: len(re.findall(r"Exchange hashpartitioning\(student_id", text)) for name, text in plans.items()}
    assert moved.pop("stg_students_clean") == 1
    assert moved.pop("student_profile") and moved and not any(moved.values()), moved
