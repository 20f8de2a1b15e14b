"""Named tables: storing, views, dropping and the shared folder."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
from types import SimpleNamespace

import pytest

from gradewell.plans.warehouse import INTERNAL, LAYERS, MODELS, Warehouse
from gradewell.session import scale_settings, shared_folder
from gradewell.sources import fixtures


@pytest.fixture(scope="module")
def warehouse(spark, small_folder, tmp_path_factory):
    raw = {
        "students": lambda: fixtures.students(spark, small_folder),
        "module": lambda: fixtures.module(spark, small_folder),
        "student_ml": lambda: fixtures.student_ml(spark, small_folder),
    }
    return Warehouse(spark, raw, folder=str(tmp_path_factory.mktemp("tables") / "w"))


def test_build_all_stores_every_table(spark, warehouse):
    warehouse.build_all()
    for name in MODELS:
        stored = spark.read.parquet(warehouse.path(name))
        assert stored.columns == warehouse.ref(name).columns
        assert stored.count() > 0, name


def test_layers_are_built_once(warehouse):
    assert all(warehouse.ref(name) is warehouse.ref(name) for name in LAYERS)


def test_views_serve_sql(spark, warehouse):
    warehouse.views("uni_")
    rows = spark.sql(
        "SELECT d.field_of_study, count(*) AS n FROM uni_fact_kpi f JOIN uni_dim_students d USING (student_id) GROUP BY 1"
    ).collect()
    assert sum(r.n for r in rows) == warehouse.ref("fact_kpi").count()
    assert set(INTERNAL) < set(MODELS)


def test_drop_deletes_and_rebuilds(warehouse):
    rows = warehouse.ref("dim_zeit").count()
    warehouse.drop()
    assert not os.path.exists(warehouse.folder)
    assert warehouse.ref("dim_zeit").count() == rows


def test_a_new_session_reuses_complete_tables(spark, warehouse):
    rows = warehouse.ref("dim_zeit").count()

    def never():
        raise AssertionError("read again")

    again = Warehouse(spark, dict.fromkeys(("students", "module", "student_ml"), never), folder=warehouse.folder)
    assert again.ref("dim_zeit").count() == rows
    assert again.ref("students").count() == warehouse.ref("students").count()


def test_scans_are_not_copied(spark, warehouse, tmp_path):
    students = warehouse.ref("students")
    other = Warehouse(spark, {"students": lambda: students}, folder=str(tmp_path / "w"), scans=("students",))
    assert other.ref("students") is students and not os.path.exists(other.path("students"))


def test_local_session_without_a_shared_folder():
    """A plain local session, without any settings of its own, stores tables in a folder of its application."""
    code = (
        "from gradewell.session import local_session, shared_folder; from gradewell.sources.sinks import write_table; "
        "s = local_session(1); a = shared_folder(s); assert a == shared_folder(s) and s.conf.get('spark.checkpoint.dir', None) is None; "
        "assert write_table(s.range(3), a + '/t').count() == 3"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.TemporaryDirectory() as empty:
        env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"}
        subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env=env | {"SPARK_CONF_DIR": empty}, timeout=300)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cluster_without_shared_folder_is_refused():
    class Cluster:
        conf = SimpleNamespace(get=lambda key, default: default)
        sparkContext = SimpleNamespace(master="spark://host")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_partitions_follow_the_input():
    assert scale_settings(100 << 40)["spark.sql.shuffle.partitions"] == str(100 << 12)
    assert scale_settings(1)["spark.sql.shuffle.partitions"] == "200"


def test_row_checks_are_counted_on_the_write(spark, tmp_path):
    from gradewell.operators import quality

    df = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, id) AS v", "concat('a', id % 3) AS s")
    declared = quality.Checks(not_null=("v", "s"), accepted={"s": ("a0", "a1")}, between={"v": (0, 49)}, unique=("id",))
    for name, rows in (("full", df), ("none", df.filter("id < 0")), ("shuffled", df.repartition(7).orderBy("id"))):
        found, counts = quality.observed(rows, declared)
        found.write.parquet(f"{tmp_path}/{name}")
        assert counts() == quality.counted(spark.read.parquet(f"{tmp_path}/{name}"), declared)
    assert quality.counted(df, declared) == {("v", "not_null"): 10, ("s", "not_null"): 0, ("s", "accepted_values"): 33, ("v", "between"): 45}
    assert quality.observed(df, quality.Checks())[1]() == {}


def test_report_reads_keys_only(small):
    """Row checks of stored tables need no scan: no column but keys is read, no row is blown up."""
    report = small.report()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    read = {c.split(":")[0] for line in plan.splitlines() if "ReadSchema: struct<" in line for c in line.split("ReadSchema: struct<")[1].split(">")[0].split(",")}
    assert read == {"student_id", "module_id", "time_id", "module_key"}
    assert report.count() == 94


def test_counts_outlive_the_session(spark, small):
    from gradewell.plans.warehouse import Warehouse

    small.report()
    later = Warehouse(spark, {}, small.folder)
    assert later.violations("fact_kpi") == small.violations("fact_kpi")
