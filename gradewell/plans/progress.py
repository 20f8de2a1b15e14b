"""Term-level KPI tables: study progress, active students, grade development."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.functions.numeric import flag, mean_grade, r, tenths

TERM_CREDITS = 30
TOLERANCE = 5


def on_track(credits: Column) -> Column:
    """1 where the credits of a term are within the tolerance of the target."""
    return F.when(F.abs(credits - TERM_CREDITS) > TOLERANCE, 0).otherwise(1)


def graded_pass() -> Column:
    return (F.col("passed_flag") == 1) & F.col("grade_numeric").isNotNull()


def passed_points() -> Column:
    """Grade tenths times credits of graded passes; NULL elsewhere."""
    return F.when(graded_pass(), tenths(F.col("grade_numeric")) * F.col("credits_earned"))


def passed_credits() -> Column:
    return F.when(graded_pass(), F.col("credits_earned"))


def term_credits(fact: DataFrame) -> DataFrame:
    """Credits per student and term."""
    return fact.groupBy("student_id", "term_counter").agg(F.sum("credits_earned").alias("credits_per_term"))


def term_progress(fact: DataFrame, by_student: bool = False) -> DataFrame:
    """Credits, modules and mean grade per student and term.

    Grouping by module first makes the distinct count a plain count.  What is
    left, at most ``MAX_TERMS`` rows per student and module, is partitioned by
    student once; the second grouping, the windows of the study progress and the
    student join all reuse that.  A fact kept ``by_student`` lies so already.
    """
    points = tenths(F.col("grade_numeric"))
    per_module = fact.groupBy("student_id", "term_counter", "module_id").agg(
        F.sum("credits_earned").alias("credits"),
        F.sum(points).alias("points"),
        F.count("grade_numeric").alias("graded"),
    )
    moved = per_module if by_student else per_module.repartition("student_id")
    return moved.groupBy("student_id", "term_counter").agg(
        F.sum("credits").alias("credits_per_term"),
        F.count("module_id").alias("modules_per_term"),
        r(mean_grade(F.sum("points"), F.sum("graded")), 2).alias("avg_grade_per_term"),
        on_track(F.sum("credits")).alias("ontrack_flag"),
    )


def study_progress(fact: DataFrame, by_student: bool = False) -> DataFrame:
    """Term progress with running credits and the change against the previous entry.

    A student has at most ``MAX_TERMS`` rows here, which bounds the window.
    """
    order = Window.partitionBy("student_id").orderBy("term_counter")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grade, credits = F.col("avg_grade_per_term"), F.col("credits_per_term")
    return term_progress(fact, by_student).select(
        "student_id",
        "term_counter",
        "credits_per_term",
        "modules_per_term",
        "avg_grade_per_term",
        F.sum(credits).over(running).alias("cumulative_ects"),
        r(grade - F.lag(grade).over(order), 2).alias("grade_change"),
        (credits - F.lag(credits).over(order)).alias("credit_change"),
        "ontrack_flag",
    )


def study_progress_rows(fact: DataFrame, students: DataFrame, by_student: bool = False) -> DataFrame:
    """Study progress with the inactivity of the student, in no particular order."""
    return study_progress(fact, by_student).join(students.select("student_id", "inactivity_flag"), "student_id")


def study_progress_kpi(rows: DataFrame) -> DataFrame:
    return rows.orderBy("student_id", "term_counter")


def active_students_kpi(enriched: DataFrame, students: DataFrame) -> DataFrame:
    """Students with at least one attempt they did not withdraw from, per term and field."""
    active = (
        enriched.filter(F.col("exam_status") != t.WITHDRAWN).select("student_id", "year", "semester_type").distinct()
    )
    return (
        active.join(students.select("student_id", "field_of_study"), "student_id")
        .groupBy("year", "semester_type", "field_of_study")
        .agg(F.count("student_id").alias("students_active_count"))
        .orderBy(F.col("year").asc_nulls_last())
    )


def grade_development_kpi(fact: DataFrame, terms: DataFrame) -> DataFrame:
    """Credit-weighted mean grade of the passes of each term."""
    sums = fact.groupBy("time_id").agg(F.sum(passed_points()).alias("points"), F.sum(passed_credits()).alias("credits"))
    return (
        sums.join(F.broadcast(terms), "time_id")
        .select("year", "semester_type", r(mean_grade(F.col("points"), F.col("credits")), 2).alias("average_grade_this_semester"))
        .orderBy(F.col("year").asc_nulls_last(), rules.semester_order(F.col("semester_type")))
    )
