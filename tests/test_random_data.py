"""All layers and KPI tables on random skewed records, against the SQL definitions.

The records hold what the derived exam data lacks: students in several fields,
one student and one module with a large share of all attempts, many attempts in
one term, catalogue modules of every kind.  A tiny task size makes hot keys of
almost every key, so the split joins are exercised.
"""

from __future__ import annotations

import random

import duckdb
import pytest

from compare import assert_same
from gradewell import types as t
from gradewell.oracle import TABLES, with_tables
from gradewell.oracle.statements import STATEMENTS
from gradewell.plans.warehouse import INTERNAL, KPIS, LAYERS, Warehouse

GRADES = ["1,0", "1,3", "2,7", "4,0", "4,3", "5,0", "5", "10", "bestanden", "angemeldet", "0,0 mE", "1,3\r\n", None]
REMARKS = [None] * 8 + ["krank", "mit Erfolg", "anerkannt", "abgemeldet", "unentschuldigt gefehlt", "kein Antrag"]
NAMES = ["Datenbanken", "Datenbanken PVL", "Wahlpflichtmodul (Ausnahme)", "Forschungs-/Entwicklungsprojekt", "Mathematische/Stochastische Modelle"]
NUMBERS = ["I707", "I143", "I200", "I201", "I705", None, "Zusatzmodul", "Wahlpflichtmodul", "I999"]


def random_students(seed: int, n: int = 1500) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        student = 7 if rng.random() < 0.35 else rng.randint(1, 40)
        field = 71 + student % 3 if rng.random() < 0.9 or student % 4 else rng.choice([71, 72, 73])
        number = "I143" if rng.random() < 0.35 else rng.choice(NUMBERS)
        rows.append(
            (
                i * 977 + 5, student, rng.choice(NAMES) if number is None else rng.choice(["Datenbanken", "Netze"]),
                rng.choice(GRADES), number, rng.choice([11, 12, 13, 14, 17, 18, 19, 29, None]),
                rng.choice(["WiSe", "SoSe", "WiSE"]), rng.choice(REMARKS), field,
            )
        )
    return rows


def random_module(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for number in ("I707", "I143", "I200", "I201", "I705", "I886", "XWM"):
        for year in t.REGULATIONS:
            for semester in t.SEMESTERS:
                for field in t.FIELDS_OF_STUDY:
                    if rng.random() < 0.45:
                        rows.append(
                            (
                                year, semester, number, f"Modul {number} {rng.randint(1, 2)}", number[-2:], "Pflichtmodul",
                                rng.choice([3, 5, 6, 10]), rng.randint(1, 4), 4, field, t.FIELDS_OF_STUDY[field], "Prof.",
                                True, False, True, False,
                            )
                        )
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def case(spark, request, tmp_path_factory):
    students = spark.createDataFrame(random_students(request.param), t.STUDENTS)
    module = spark.createDataFrame(random_module(request.param), t.MODULE)
    scores = spark.createDataFrame([(s, s % 2 == 0, 0.5, False, 0.7, "a", "b") for s in range(1, 30)], t.STUDENT_ML)
    raw = {"students": students, "module": module, "student_ml": scores}
    folder = str(tmp_path_factory.mktemp("random"))
    warehouse = Warehouse(spark, {k: (lambda df=df: df) for k, df in raw.items()}, folder=folder, rows_per_task=20)
    db = duckdb.connect()
    for name in raw:
        warehouse.ref(name)
        db.execute(f"CREATE VIEW raw_{name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    return warehouse, db


@pytest.mark.parametrize("name", ["risk_flag", "early_warning_metrics", "invalid_combo_report", "anomaly_counts"])
def test_risk_and_reports(case, name):
    from gradewell.plans import checks, risk

    w, db = case
    build = {
        "risk_flag": lambda: risk.risk_flag(w.ref("student_kpi"), w.ref("dim_students")),
        "early_warning_metrics": lambda: risk.early_warning_metrics(
            w.ref("student_kpi"), w.ref("dim_students"), w.ref("study_progress_rows"), w.ref("stg_students_clean")
        ),
        "invalid_combo_report": lambda: checks.invalid_combo_report(w.ref("stg_students_with_credits"), w.ref("dim_modul")),
        "anomaly_counts": lambda: checks.anomaly_counts(w.ref("students"), w.ref("stg_students_with_credits"), w.ref("dim_modul")),
    }
    given = tuple(n for n in TABLES if n in ("raw_students", "raw_module", "raw_student_ml"))
    assert assert_same(build[name](), db, with_tables(STATEMENTS[name], given)) > 0


CHECKED = [n for n in (*LAYERS, *KPIS) if n not in INTERNAL]


@pytest.mark.parametrize("name", CHECKED)
def test_model(case, name):
    warehouse, db = case
    given = tuple(n for n in TABLES if n in ("raw_students", "raw_module", "raw_student_ml"))
    assert assert_same(warehouse.ref(name), db, with_tables(STATEMENTS[name], given)) > 0


def test_running_pass_count(case):
    from gradewell.operators.enrichment import running_pass_count

    warehouse, db = case
    expected = """SELECT attempt_id, CAST(sum(CASE WHEN exam_status = 'bestanden' THEN 1 ELSE 0 END)
        OVER (PARTITION BY student_id, module_number ORDER BY term_counter, attempt_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS passed_so_far
        FROM stg_students_clean"""
    found = running_pass_count(warehouse.ref("stg_students_clean"), rows_per_task=20).select("attempt_id", "passed_so_far")
    assert_same(found, db, with_tables(expected, ("raw_students", "raw_module")))
