"""Row rules on literal records."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.functions.numeric import r, ratio
from gradewell.operators import cleaning


def raw(spark, *records):
    """Raw attempts from partial records; ids are numbered."""
    defaults = {"studentID": 1, "Modul": "Modul", "Note": None, "Modulnummer": "I1", "Jahr": 18, "Semester": "WiSe", "Vermerk": None, "Studienrichtung": 71}
    rows = [{"attempt_id": i, **defaults, **record} for i, record in enumerate(records)]
    return spark.createDataFrame([tuple(row[f.name] for f in t.STUDENTS.fields) for row in rows], t.STUDENTS)


def column(df, name):
    return [row[name] for row in df.orderBy("attempt_id").collect()]


# The grade spellings of the raw data.
PLAIN_GRADES = (
    "3,0 2,4 1 2,0 1,5 1,8 4,0 5 1,0 1,1 3,8 3,5 2,7 1,2 2 2,3 2,5 3 2,6 2,8 4 2,9 1,3 1,6 3,2 3,1 3,7 2,1 3,6 2,2 1,4 1,9 1,7 3,3 1,00 3,4"
).split()
OTHER_GRADES = {"1,3\r\n": "1.3", "10": "1.0", "02.01.1900": None, "0,0 mE": None, "angemeldet": None, "bestanden": None, None: None}


def test_all_grade_spellings(spark):
    assert len(PLAIN_GRADES) + len(OTHER_GRADES) == 43
    expected = [Decimal(g.replace(",", ".")).quantize(Decimal("0.1")) for g in PLAIN_GRADES]
    expected += [v and Decimal(v) for v in OTHER_GRADES.values()]
    df = cleaning.with_grades(raw(spark, *[{"Note": g} for g in (*PLAIN_GRADES, *OTHER_GRADES)]))
    assert column(df, "grade_numeric") == expected
    assert dict(df.dtypes)["grade_numeric"] == "decimal(3,1)"


def test_grade_text_and_odd_numbers(spark):
    notes = ["1,3\r\n", " 2 , 0\t", "10", "", "abc", "100,5", "1,25"]
    df = cleaning.with_grades(raw(spark, *[{"Note": n} for n in notes]))
    assert column(df, "grade") == ["1,3", "2,0", "1,0", "", "abc", "100,5", "1,25"]
    assert column(df, "grade_numeric") == [Decimal("1.3"), Decimal("2.0"), Decimal("1.0"), None, None, None, Decimal("1.3")]


STATUS = [
    ("bestanden", "krank", t.PASSED),
    (None, "mit Erfolg", t.PASSED),
    ("", "mit Erfolg", t.PASSED),
    ("02.01.1900", "mit Erfolg", t.PASSED),
    (None, None, t.WITHDRAWN),
    ("1,0", "krank", t.WITHDRAWN),
    ("5,0", "nicht zugelassen", t.WITHDRAWN),
    ("angemeldet", None, t.WITHDRAWN),
    ("1,0", "unentschuldigt gefehlt", t.FAILED),
    ("4,0", None, t.PASSED),
    ("5", None, t.FAILED),
    ("5,0", "abgemeldet", t.FAILED),
    (None, "abgemeldet", t.WITHDRAWN),
    ("abc", None, t.PASSED),
    ("4,5", None, t.PASSED),
    ("4,5", "abgemeldet", t.WITHDRAWN),
    (None, "anerkannt", None),
    ("02.01.1900", None, None),
    ("", None, None),
]


def test_exam_status(spark):
    df = raw(spark, *[{"Note": n, "Vermerk": v} for n, v, _ in STATUS])
    assert column(cleaning.derive_exam_status(cleaning.with_grades(df)), "exam_status") == [s for _, _, s in STATUS]


def test_remarks(spark):
    cases = [
        ("1,0", "abgemeldet", "abgemeldet"), ("1,0", "anerkannt", "anerkannt"), ("1,0", "krank", "krank"),
        ("1,0", "nicht zugelassen", "nicht zugelassen"), ("1,0", "unentschuldigt gefehlt", "unentschuldigt gefehlt"),
        ("1,0", "mit Erfolg", None), ("1,0", "kein Antrag", None), ("1,0", "other", None), ("1,0", None, None),
        ("5", "krank", None), ("5", "unentschuldigt gefehlt", "unentschuldigt gefehlt"), ("5", None, None),
        ("5,0", "krank", "krank"), (None, "krank", "krank"),
    ]
    df = cleaning.clean_remark(raw(spark, *[{"Note": n, "Vermerk": v} for n, v, _ in cases]))
    assert column(df, "exam_annotation") == [e for _, _, e in cases]


def test_module_numbers(spark):
    cases = [
        (None, "Wahlpflichtmodul (Ausnahme) X", "XWM"), (None, "Wahlpflichtmodul (anerkannt)", "XWM"),
        (None, "Zusatzmodul 3", "XZM"), (None, "Wahlpflichtmodul (Ausnahme) Zusatzmodul", "XWM"),
        (None, "I705 Forschungs-/Entwicklungsprojekt", "I705"), (None, "Mathematische/Stochastische Modelle", "I886"),
        (None, "Something", "XQQ"), ("Zusatzmodul", "x", "XZM"), ("Wahlpflichtmodul", "x", "XWM"), ("I364", "Zusatzmodul", "I364"),
    ]
    df = cleaning.map_module_number(raw(spark, *[{"Modulnummer": n, "Modul": m} for n, m, _ in cases]))
    assert column(df, "module_number") == [e for _, _, e in cases]


def test_partial_examinations_are_dropped(spark):
    kept = ["Datenbanken", "beleg", "Forschungsseminar", "Forschungsseminar Teil 3", "Sp"]
    dropped = [f"a {m} b" for m in t.PARTIAL_EXAM_MARKERS] + [None]
    df = cleaning.filter_main_grades(raw(spark, *[{"Modul": m} for m in (*kept, *dropped)]))
    assert column(df, "Modul") == kept


def test_terms(spark):
    cases = [(29, "WiSE", 19, "WiSe"), (11, "sose", 11, "SoSe"), (25, "WISE", 25, "WiSe"), (10, "x", None, "x"), (26, None, None, None), (None, "SoSe", None, "SoSe")]
    df = cleaning.with_term(raw(spark, *[{"Jahr": y, "Semester": s} for y, s, _, _ in cases]))
    assert column(df, "year") == [y for _, _, y, _ in cases]
    assert column(df, "semester_type") == [s for _, _, _, s in cases]
    assert cleaning.drop_undated(df).count() == 3


def test_unknown_semester_stops_or_is_rejected(spark):
    df = raw(spark, {"Semester": "WiSe"}, {"Semester": "Trimester"}, {"Semester": "Trimester", "Jahr": None})
    with pytest.raises(PySparkException, match="semester_type outside its domain: Trimester"):
        cleaning.clean_rows(df).collect()
    assert cleaning.clean_rows(df, on_invalid="reject").count() == 1


def test_student_level_columns(spark):
    df = cleaning.stg_students_clean(
        raw(
            spark,
            {"Jahr": 18, "Semester": "WiSe", "Studienrichtung": 72},
            {"Jahr": 18, "Semester": "SoSe", "Studienrichtung": 71},
            {"Jahr": 20, "Semester": "SoSe", "Studienrichtung": 73, "Modulnummer": "Zusatzmodul"},
            {"Jahr": 20, "Semester": "SoSe", "Studienrichtung": 73, "Modulnummer": "Zusatzmodul"},
            {"studentID": 2, "Modulnummer": None, "Studienrichtung": 73},
        )
    )
    assert column(df, "term_counter") == [2, 1, 3, 3, 1]
    assert column(df, "year_of_matriculation") == [18] * 5
    assert column(df, "semester_of_matriculation") == ["SoSe"] * 4 + ["WiSe"]
    # Tie between 71 and 72: the smaller field; placeholders alone keep their own.
    assert column(df, "field_of_study") == [72, 71, 71, 71, 73]


def test_rounding_and_division(spark):
    df = spark.createDataFrame([(1.005, 0.0), (2.675, 2.0), (-1.005, 4.0)], "x double, y double")
    assert [row[0] for row in df.select(r(F.col("x"), 2)).collect()] == [1.0, 2.68, -1.0]
    assert [row[0] for row in df.select(ratio(F.lit(1), F.col("y"))).collect()] == [None, 0.5, 0.25]


def test_module_key_skips_missing_parts(spark):
    df = spark.createDataFrame([(11, "WiSe", "I1", 71), (None, "WiSe", None, 71)], "a int, b string, c string, d int")
    key = rules.module_key(*[F.col(c) for c in "abcd"])
    assert [row[0] for row in df.select(key).collect()] == ["11-WiSe-I1-71", "-WiSe--71"]
