"""Input schemas and the value domains of the coded columns."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PASSED = "bestanden"
FAILED = "nicht bestanden"
WITHDRAWN = "abgemeldet"
EXAM_STATUS = (PASSED, FAILED, WITHDRAWN)

WINTER = "WiSe"
SUMMER = "SoSe"
# Declaration order is the sort order of the term name in term tables.
SEMESTERS = (WINTER, SUMMER)

REMARKS = ("abgemeldet", "anerkannt", "krank", "nicht zugelassen", "unentschuldigt gefehlt")

THESIS = "I707"
ELECTIVE = "XWM"
ADDITIONAL = "XZM"
UNKNOWN_MODULE = "XQQ"
PLACEHOLDERS = (ELECTIVE, ADDITIONAL, UNKNOWN_MODULE)

FIELDS_OF_STUDY = {
    71: "Informations- und Kommunikationstechnologien",
    72: "Wirtschaftsinformatik",
    73: "Medieninformatik",
    74: "Data Science",
}

REGULATIONS = (11, 18)
FIRST_YEAR = 11
LAST_YEAR = 25

# Substrings of a module name that mark a partial examination.
PARTIAL_EXAM_MARKERS = (
    "APL",
    "SPL",
    "PVL",
    "MP",
    "schriftlicher Teil",
    "mündlicher Teil",
    "mndlicher Teil",
    "SP",
    "Semesterarbeit",
    "BGA",
    "Beleg",
    "schriftlich",
    "Verteidigung",
    "schriftliche Arbeit",
    "Forschungseminar 1",
    "Forschungseminar 2",
    "Forschungseminar Teil 1",
    "Forschungseminar Teil 2",
    "Forschungsseminar 1",
    "Forschungsseminar 2",
    "Forschungsseminar Teil 1",
    "Forschungsseminar Teil 2",
)
# --- end of fixed values ----------------------------------------------------

# Position of the first possible term (summer of FIRST_YEAR) on the term axis.
FIRST_TERM_INDEX = FIRST_YEAR * 2 + 1
# Two terms a year: every per-student term list is at most this long.
MAX_TERMS = (LAST_YEAR - FIRST_YEAR + 1) * 2

STUDENTS = T.StructType(
    [
        T.StructField("attempt_id", T.LongType(), False),
        T.StructField("studentID", T.LongType(), False),
        T.StructField("Modul", T.StringType()),
        T.StructField("Note", T.StringType()),
        T.StructField("Modulnummer", T.StringType()),
        T.StructField("Jahr", T.LongType()),
        T.StructField("Semester", T.StringType()),
        T.StructField("Vermerk", T.StringType()),
        T.StructField("Studienrichtung", T.LongType(), False),
    ]
)

MODULE = T.StructType(
    [
        T.StructField("AbJahr", T.IntegerType()),
        T.StructField("AbSemester", T.StringType()),
        T.StructField("Modulnummer", T.StringType()),
        T.StructField("Modul", T.StringType()),
        T.StructField("Acronym", T.StringType()),
        T.StructField("Art", T.StringType()),
        T.StructField("Credits", T.IntegerType()),
        T.StructField("Semester", T.IntegerType()),
        T.StructField("Wochenstunden", T.IntegerType()),
        T.StructField("Studienrichtung", T.IntegerType()),
        T.StructField("Richtung", T.StringType()),
        T.StructField("Professor", T.StringType()),
        T.StructField("PVL", T.BooleanType()),
        T.StructField("APL", T.BooleanType()),
        T.StructField("schriftliche Prüfung", T.BooleanType()),
        T.StructField("mündliche Prüfung", T.BooleanType()),
    ]
)

FIELD_LOOKUP = T.StructType(
    [T.StructField("strID", T.LongType(), False), T.StructField("studienrichtung", T.StringType(), False)]
)

STUDENT_ML = T.StructType(
    [
        T.StructField("student_id", T.LongType(), False),
        T.StructField("predicted_has_passed_degree", T.BooleanType()),
        T.StructField("has_passed_degree_confidence", T.DoubleType()),
        T.StructField("predicted_inactivity", T.BooleanType()),
        T.StructField("inactivity_confidence", T.DoubleType()),
        T.StructField("lime_top5_inact", T.StringType()),
        T.StructField("lime_top5_pass", T.StringType()),
    ]
)
