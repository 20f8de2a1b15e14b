"""KPI tables per student."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag, mean_grade, percent, r, tenths
from gradewell.operators.summary import grade_rows

SCORES = (
    "predicted_has_passed_degree", "has_passed_degree_confidence", "predicted_inactivity",
    "inactivity_confidence", "lime_top5_inact", "lime_top5_pass",
)


def student_module_rollup(fact: DataFrame) -> DataFrame:
    """Outcome per student and module; every attempt that is no pass counts as failed."""
    return fact.groupBy("student_id", "module_id").agg(
        F.max(flag(F.col("passed_flag") == 1)).alias("module_passed"),
        F.sum(flag(F.col("passed_flag") == 0)).alias("failed_attempts"),
        F.count("*").alias("attempts"),
        F.sum("credits_earned").alias("credits_count_temp"),
    )


def grade_counts(fact: DataFrame) -> DataFrame:
    """Attempts and credits per student and grade: a grade has one decimal, so
    a student has a few dozen rows however many attempts there are."""
    return (
        fact.filter(F.col("grade_numeric").isNotNull())
        .groupBy("student_id", "grade_numeric")
        .agg(F.count("*").alias("n"), F.sum("credits_earned").alias("credits"))
    )


def student_grades(fact: DataFrame) -> DataFrame:
    """Credit-weighted mean and median of all grades of a student."""
    points = tenths(F.col("grade_numeric")) * F.col("credits")
    return grade_counts(fact).groupBy("student_id").agg(
        r(mean_grade(F.sum(points), F.sum("credits")), 2).alias("weighted_avg_grade"),
        F.percentile("grade_numeric", 0.5, F.col("n")).alias("median_grade"),
    )


def student_kpi(summary: DataFrame) -> DataFrame:
    """One row per student, from the summary of the attempts; grouped and joined where its buckets are."""
    points = tenths(F.col("grade")) * F.col("credits")
    grades = grade_rows(summary).filter(F.col("grade").isNotNull()).groupBy("student_id").agg(
        r(mean_grade(F.sum(points), F.sum("credits")), 2).alias("weighted_avg_grade"),
        F.percentile("grade", 0.5, F.col("n")).alias("median_grade"),
    )
    totals = summary.select(
        "student_id",
        F.col("modules").alias("modules_count"),
        F.col("modules_passed").alias("modules_passed_count"),
        F.col("failed_attempts").alias("failed_attempts_count"),
        F.col("modules_repeated").alias("modules_failed_count"),
        F.col("credits").alias("credits_total_count"),
    )
    count = F.col("modules_count")
    pass_share = F.lit(100.0) * F.col("modules_passed_count") / count
    return totals.join(grades.hint("merge"), "student_id", "left").select(
        *totals.columns,
        "weighted_avg_grade",
        "median_grade",
        r(pass_share, 2).alias("pass_rate"),
        r(100 - pass_share, 2).alias("fail_rate"),
        percent(F.col("modules_failed_count"), count).alias("repetition_rate"),
    )


def student_kpi_ml(kpi: DataFrame, scores: DataFrame) -> DataFrame:
    """Student KPIs with the scores of the prediction model.

    Scores are one row per student.  Should a student have several, the
    smallest value of each column is shown and the counts and sums repeat per
    score row, as a join before the aggregation does.
    """
    per_student = scores.groupBy("student_id").agg(
        F.count("*").alias("score_rows"), *[F.min(c).alias(c) for c in SCORES]
    )
    times = F.coalesce("score_rows", F.lit(1))
    joined = kpi.join(per_student, "student_id", "left")
    additive = ("modules_count", "modules_passed_count", "failed_attempts_count", "modules_failed_count", "credits_total_count")
    return joined.withColumns({c: F.col(c) * times for c in additive}).drop("score_rows")


def studienrichtung_mark_kpi(fact: DataFrame) -> DataFrame:
    """Mean final grade and mean thesis grade of students with a graded thesis, one row."""
    thesis = F.when(F.col("module_id") == t.THESIS, F.col("grade_numeric"))
    per_student = (
        fact.groupBy("student_id")
        .agg(
            mean_grade(F.sum(tenths(F.col("grade_numeric"))), F.count("grade_numeric")).alias("avg_grade"),
            F.min(thesis).alias("thesis_grade"),
        )
        .filter(F.col("thesis_grade").isNotNull())
    )
    return per_student.agg(
        r(F.avg("avg_grade"), 2).alias("students_with_thesis_avg_final_grade"),
        r(mean_grade(F.sum(tenths(F.col("thesis_grade"))), F.count("*")), 2).alias(
            "students_with_thesis_avg_master_thesis_grade"
        ),
    )
