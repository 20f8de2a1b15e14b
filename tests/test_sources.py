"""Readers, sinks and the stream."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.operators.cleaning import clean_rows, split_rows, unchecked_rows
from gradewell.sources import fixtures, readers, sinks
from gradewell.streaming.ingest import append_rows, appended_rows


def same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_seed_csv(small, spark, tmp_path):
    path = str(tmp_path / "module")
    small.ref("module").write.csv(path, header=True, encoding="UTF-8")
    read = readers.read_module_seed(spark, path)
    assert [f.dataType for f in read.schema] == [f.dataType for f in t.MODULE]
    assert same(read, small.ref("module"))


def test_students_from_csv_and_json(small, spark, tmp_path):
    few = small.ref("students").filter("attempt_id % 50 = 0").filter("Note is null or Note not like '%\r%'")
    few.write.json(str(tmp_path / "json"))
    assert same(readers.read_students(spark, str(tmp_path / "json"), "json"), few)
    few.write.csv(str(tmp_path / "csv"), header=True)
    assert same(readers.read_students(spark, str(tmp_path / "csv"), "csv", header="true"), few)


def test_records_without_id_are_numbered(small, spark, tmp_path):
    students = small.ref("students").drop("attempt_id").limit(500)
    students.write.parquet(str(tmp_path / "parquet"))
    students.write.json(str(tmp_path / "json"))
    for fmt in ("parquet", "json"):
        rows = readers.read_students(spark, str(tmp_path / fmt), fmt, has_id=False)
        assert rows.select("attempt_id").distinct().count() == 500
        assert [f.name for f in rows.schema] == [f.name for f in t.STUDENTS]


def test_field_names(small, spark):
    named = readers.with_field_name(small.ref("dim_students"), readers.fields_of_study(spark))
    assert {r.field_name for r in named.select("field_name").distinct().collect()} == {t.FIELDS_OF_STUDY[f] for f in (71, 72, 73)}


def test_sinks_replace(small, spark, tmp_path):
    terms = small.ref("dim_zeit")
    path = str(tmp_path / "terms")
    sinks.write_table(terms, path)
    assert same(sinks.write_table(terms.filter("year < 15"), path), terms.filter("year < 15"))
    name = f"terms_{uuid.uuid4().hex}"
    sinks.create_or_replace_table(terms, name, str(tmp_path / name))
    assert same(sinks.create_or_replace_table(terms.filter("year < 15"), name, str(tmp_path / name)), terms.filter("year < 15"))
    sinks.create_view(terms, name + "_v")
    assert sinks.create_view(terms.filter("year < 15"), name + "_v").count() == terms.filter("year < 15").count()
    sinks.drop_view(spark, name + "_v")


def test_stream_cleans_each_file_once(small, spark, tmp_path):
    """Accepted and rejected rows together are the input, in batch and as a stream."""
    arriving, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    odd = F.when(F.col("attempt_id") % 7 == 0, "Trimester").otherwise(F.col("Semester"))
    students = small.ref("students").withColumn("Semester", odd)
    students.filter("attempt_id % 2 = 0").write.parquet(arriving)
    append_rows(spark, arriving, target, state).awaitTermination()
    students.filter("attempt_id % 2 = 1").write.mode("append").parquet(arriving)
    append_rows(spark, arriving, target, state).awaitTermination()
    valid, rejected = split_rows(students)
    assert same(valid, appended_rows(spark, target)) and same(rejected, appended_rows(spark, target, valid=False))
    assert rejected.count() > 0 and valid.count() + rejected.count() == unchecked_rows(students).count()
    with pytest.raises(PySparkException, match="outside its domain: Trimester"):
        clean_rows(students).collect()


def test_order_with_too_many_lines_is_refused(spark, small_folder):
    tables = [fixtures.read_source(spark, small_folder, n) for n in ("lineitem", "orders", "part")]
    first = tables[0].orderBy("l_orderkey").limit(1)
    lines = first.crossJoin(spark.range(100)).withColumn("l_linenumber", F.col("id").cast("int")).drop("id")
    with pytest.raises(PySparkException, match="more than 99 lines"):
        fixtures.derive_students(lines, *tables[1:]).collect()


def test_changed_input_is_noticed(spark, small_folder, tmp_path):
    """A second look at a folder whose files changed builds new tables."""
    import shutil

    from gradewell.plans.warehouse import fixture_warehouse
    from gradewell.sources.fixtures import SOURCE_TABLES, read_source

    for name in SOURCE_TABLES:
        shutil.copyfile(f"{small_folder}/{name}.parquet", tmp_path / f"{name}.parquet")
    folder = str(tmp_path)
    first = fixture_warehouse(spark, folder)
    assert fixture_warehouse(spark, folder) is first
    read_source(spark, small_folder, "customer").limit(5).toPandas().to_parquet(tmp_path / "customer.parquet")
    assert fixture_warehouse(spark, folder) is not first


def test_lines_of_a_seed_that_do_not_parse(spark, small, tmp_path):
    path = str(tmp_path / "seed")
    rows = small.ref("module")
    rows.coalesce(1).write.csv(path, header=True, encoding="UTF-8")
    n = rows.count()
    names = rows.columns
    number = next(f.name for f in rows.schema.fields if f.dataType.simpleString() in ("int", "bigint"))
    bad = ",".join("many" if c == number else "x" for c in names)
    with open(f"{path}/more.csv", "w", encoding="UTF-8") as file:
        file.write(",".join(names) + "\n" + bad + "\n" + "only one\n" + ",".join(["1"] * (len(names) + 2)) + "\n")
    accepted, rejected = readers.read_module_seed_lines(spark, path)
    assert accepted.exceptAll(rows).isEmpty() and accepted.count() == n and accepted.schema == rows.schema
    found = rejected.collect()
    assert len(found) == 3 and bad in {r.line for r in found} and all(r.file.endswith("more.csv") for r in found)
