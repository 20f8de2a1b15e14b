"""The checks declared for the tables, and reports on the raw and staged data."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.operators.quality import Checks

BOTH = (True, False)
STUDENT_COLUMNS = (
    "student_id", "graduation_flag", "year_of_matriculation", "semester_of_matriculation",
    "study_regulations_year", "field_of_study", "terms_taken_total_count",
)
STUDENT_VALUES = {
    "semester_of_matriculation": t.SEMESTERS,
    "study_regulations_year": t.REGULATIONS,
    "graduation_flag": BOTH,
}

# --- fixed values: declared checks -------------------------------------------
DECLARED = {
    "dim_students": Checks(
        not_null=(*STUDENT_COLUMNS, "inactivity_flag"),
        unique=("student_id",),
        accepted={**STUDENT_VALUES, "inactivity_flag": BOTH},
    ),
    "stg_students_with_credits": Checks(
        not_null=(
            "student_id", "module_number", "exam_status", "semester_type", "year", "term_counter", "credits_earned",
            "match_quality", "module_not_in_plan", "module_title", "tries_count", "withdrawal_count", "sanity_check",
        ),
        accepted={
            "exam_status": t.EXAM_STATUS,
            "semester_type": t.SEMESTERS,
            "match_quality": (0, 1, 2, 3),
            "module_not_in_plan": BOTH,
            "sanity_check": BOTH,
        },
        between={"credits_earned": (0, 30), "tries_count": (1, 20), "withdrawal_count": (0, 20)},
    ),
    "dim_students_with_credits": Checks(
        not_null=(
            *STUDENT_COLUMNS, "credits_earned_total_count", "passed_xwm_xzm_count",
            "total_credits_with_xwm_xzm_bonus", "sanity_check",
        ),
        unique=("student_id",),
        accepted={**STUDENT_VALUES, "sanity_check": BOTH},
        between={"credits_earned_total_count": (0, 150)},
    ),
    "dim_zeit": Checks(
        not_null=("time_id", "year", "semester_type", "semester_type_numeric", "time_label"),
        unique=("time_id",),
        accepted={"semester_type": t.SEMESTERS, "semester_type_numeric": (0, 1)},
    ),
    "dim_modul": Checks(
        not_null=(
            "module_id", "module_title", "module_acronym", "graduation_year", "graduation_semester", "module_key",
            "field_of_study",
        ),
        unique=("module_key",),
        accepted={
            "graduation_year": t.REGULATIONS,
            "graduation_semester": t.SEMESTERS,
            "field_of_study": tuple(t.FIELDS_OF_STUDY),
        },
    ),
    "fact_kpi": Checks(
        not_null=("student_id", "module_id", "term_counter", "passed_flag", "credits_earned"),
        accepted={"passed_flag": (0, 1)},
        between={"credits_earned": (0, 30)},
        parents={
            "student_id": ("dim_students", "student_id"),
            "module_id": ("dim_modul", "module_id"),
            "time_id": ("dim_zeit", "time_id"),
        },
    ),
    "student_kpi": Checks(
        not_null=("student_id",),
        between={"weighted_avg_grade": (1, 4), "median_grade": (1, 5)},
        parents={"student_id": ("dim_students", "student_id")},
    ),
    "modul_kpi": Checks(not_null=("module_id",), parents={"module_id": ("dim_modul", "module_id")}),
    "studiengang_kpi": Checks(
        not_null=("students_total_count", "weighted_avg_program_grade", "median_program_grade")
    ),
    "studiengangsvergleich_kpi": Checks(
        not_null=("field_of_study", "year_of_matriculation", "matriculations_count"),
        accepted={"field_of_study": (71, 72, 73)},
        between={"year_of_matriculation": (11, 21)},
    ),
}
# --- end of fixed values -------------------------------------------------------

RAW_COLUMNS = ("studentID", "Modul", "Note", "Modulnummer", "Jahr", "Semester", "Vermerk", "Studienrichtung")
PROFILED = ("Note", "Modulnummer", "Jahr", "Semester", "Vermerk", "Studienrichtung")

#: What raw records ought to determine (our choice).
DEPENDENCIES = [
    (("Modulnummer",), "Modul"),
    (("Modul",), "Modulnummer"),
    (("studentID",), "Studienrichtung"),
    (("studentID", "Modulnummer", "Jahr", "Semester"), "Note"),
]
#: Columns of the catalogue among which dependencies are searched.
SEARCHED = ("Modulnummer", "Modul", "Acronym", "Art", "Credits", "Semester", "AbJahr", "Studienrichtung")


def dedupe_raw(students: DataFrame) -> DataFrame:
    """Equal raw records once, with the smallest id.

    Grouping keeps one row per record in every map task, so a record copied
    any number of times is no burden to the shuffle.
    """
    return students.groupBy(*RAW_COLUMNS).agg(F.min("attempt_id").alias("attempt_id"))


def _named_counts(df: DataFrame, conditions: dict) -> DataFrame:
    """One pass over the rows, one output row per named condition."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    rows = [F.struct(F.lit(name).alias("finding"), F.col(name).alias("n_rows")) for name in conditions]
    return counts.select(F.inline(F.array(*rows)))


# --- fixed values: limits of the report (our choice) -------------------------
LONG_STUDY_TERMS = 8
MOST_CREDITS_PER_TERM = 60
# --- end of fixed values -------------------------------------------------------


def invalid_combo_report(enriched: DataFrame, modules: DataFrame) -> DataFrame:
    """Combinations that should not occur: rows, terms of a student with too many credits, and catalogue modules."""
    per_term = enriched.groupBy("student_id", "year", "semester_type").agg(F.sum("credits_earned").alias("sum"))
    per_module = modules.groupBy("module_id").agg(F.countDistinct("credits").alias("n"))
    return (
        _row_combinations(enriched)
        .unionByName(_without_credits(enriched, modules, "passed_without_credits", F.col("exam_status") == t.PASSED))
        .unionByName(_named_counts(per_term, {"unrealistic_credit_sum": F.col("sum") > MOST_CREDITS_PER_TERM}))
        .unionByName(_named_counts(per_module, {"module_with_differing_credits": F.col("n") > 1}))
    )


def _without_credits(enriched: DataFrame, modules: DataFrame, finding: str, condition: Column) -> DataFrame:
    """Number of matched rows whose catalogue entry has no credits; rows are counted per entry before the join."""
    lacking = modules.filter(F.col("credits").isNull()).select("module_key").distinct()
    counted = enriched.groupBy("module_key").agg(F.count_if(condition).alias("n"))
    found = counted.join(lacking, "module_key", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows"))
    return found.select(F.lit(finding).alias("finding"), "n_rows")


def _row_combinations(enriched: DataFrame) -> DataFrame:
    passed, failed, withdrawn = (F.col("exam_status") == s for s in (t.PASSED, t.FAILED, t.WITHDRAWN))
    grade = F.col("grade")
    return _named_counts(
        enriched,
        {
            "passed_without_catalogue_entry": passed & F.col("module_key").isNull(),
            "passed_with_failing_grade": passed & (grade > 4),
            "failed_with_passing_grade": failed & (grade <= 4),
            "withdrawn_with_grade": withdrawn & grade.isNotNull(),
            "no_status": F.col("exam_status").isNull(),
            "no_status_with_grade": F.col("exam_status").isNull() & grade.isNotNull(),
            "unusually_long_study": F.col("term_counter") > LONG_STUDY_TERMS,
        },
    )


def anomaly_counts(students: DataFrame, enriched: DataFrame, modules: DataFrame) -> DataFrame:
    """Missing catalogue credits and odd year or semester values."""
    odd_terms = _named_counts(
        students,
        {
            "year_missing": F.col("Jahr").isNull(),
            "year_corrected": F.col("Jahr") == rules.YEAR_TYPO,
            "year_out_of_range": F.col("Jahr").isNotNull() & rules.exam_year(F.col("Jahr")).isNull(),
            "semester_missing": F.col("Semester").isNull(),
            "semester_respelled": rules.semester(F.col("Semester")) != F.col("Semester"),
            "semester_unknown": ~rules.semester(F.col("Semester")).isin(*t.SEMESTERS),
        },
    )
    return odd_terms.unionByName(_named_counts(enriched, {"catalogue_entry_missing": F.col("module_key").isNull()})).unionByName(
        _without_credits(enriched, modules, "catalogue_credits_missing", F.lit(True))
    )


def profile_distinct(students: DataFrame) -> DataFrame:
    """Values of the coded columns with their number of rows.

    One scan: every column is counted on its own map side before the shuffle.
    """
    rows = students.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in PROFILED])
        )
    )
    return rows.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
