"""Rule-based risk of a student."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions import rules
from gradewell.plans.progress import TERM_CREDITS

# --- fixed values: thresholds ---------------------------------------------------
RED_FAILED_ATTEMPTS = 2
RED_GRADE, ORANGE_GRADE = 3.5, 3.0
RED_FAIL_RATE, ORANGE_FAIL_RATE = 40, 20
RED_BACKLOG, ORANGE_BACKLOG = 60, 30
# --- end of fixed values ----------------------------------------------------------


def any_true(*conditions: Column) -> Column:
    """True if one condition is true; an unknown one counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def credit_backlog() -> Column:
    """Credits missing against the target of the terms taken."""
    return F.col("terms_taken_total_count") * TERM_CREDITS - F.col("credits_total_count")


def risk_flag(student_kpi: DataFrame, students: DataFrame) -> DataFrame:
    """RED, ORANGE or GREEN per student; the dimension has several rows for a student of several fields."""
    per_student = students.groupBy("student_id").agg(
        F.max("terms_taken_total_count").alias("terms_taken_total_count"), F.bool_or("inactivity_flag").alias("inactivity_flag")
    )
    rows = student_kpi.join(per_student, "student_id")
    grade, fail_rate = F.col("weighted_avg_grade"), F.col("fail_rate")
    red = any_true(
        F.col("failed_attempts_count") >= RED_FAILED_ATTEMPTS,
        grade >= RED_GRADE,
        credit_backlog() > RED_BACKLOG,
        fail_rate > RED_FAIL_RATE,
    )
    orange = any_true(
        fail_rate > ORANGE_FAIL_RATE, grade >= ORANGE_GRADE, credit_backlog() > ORANGE_BACKLOG, F.col("inactivity_flag")
    )
    return rows.select("student_id", F.when(red, "RED").when(orange, "ORANGE").otherwise("GREEN").alias("risk_flag"))


def early_warning_metrics(student_kpi: DataFrame, students: DataFrame, progress: DataFrame, clean: DataFrame) -> DataFrame:
    """The named early-warning inputs; the formulas are ours.

    Credit backlog against the target, modules taken more than once, change of
    the mean grade in the latest term, and terms since the last attempt.
    """
    latest = progress.groupBy("student_id").agg(F.max_by("grade_change", "term_counter").alias("grade_trend"))
    index = rules.term_index(F.col("year"), F.col("semester_type"))
    last_term = clean.groupBy("student_id").agg(F.max(index).alias("last_term"))
    now = clean.agg(F.max(index)).scalar()
    terms = students.groupBy("student_id").agg(F.max("terms_taken_total_count").alias("terms_taken_total_count"))
    return (
        student_kpi.join(terms, "student_id")
        .join(latest, "student_id", "left")
        .join(last_term, "student_id")
        .select(
            "student_id",
            credit_backlog().alias("ects_backlog"),
            F.col("modules_failed_count").alias("repeated_modules"),
            "grade_trend",
            (now - F.col("last_term")).alias("inactive_terms"),
        )
    )
