"""KPI table per intake year.

The definition joins every attempt with all catalogue rows of its module.  Here
each attempt carries that number and its credits as weights instead, and attempts
are summed per student first (``operators.summary``), so neither the fan-out nor
a large cohort ever meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.functions.numeric import flag, mean_grade, percent, r, tenths
from gradewell.operators.summary import grade_rows
from gradewell.plans.progress import TERM_CREDITS, TOLERANCE, term_credits


def cohort_ontrack(fact: DataFrame, students: DataFrame) -> DataFrame:
    """Terms on track and all terms per intake year."""
    copies = students.groupBy("year_of_matriculation", "student_id").agg(F.count("*").alias("copies"))
    credits = F.col("credits_per_term") * F.col("copies")
    return (
        term_credits(fact)
        .join(copies, "student_id")
        .groupBy("year_of_matriculation")
        .agg(
            F.sum(flag(F.abs(credits - TERM_CREDITS) <= TOLERANCE)).alias("ontrack_terms"),
            F.count("*").alias("total_terms"),
        )
    )


def cohort_grades(reached: DataFrame) -> DataFrame:
    """Mean and median grade per intake year, weighted by the catalogue rows of the module."""
    per_cohort = (
        grade_rows(reached, "year_of_matriculation", "copies")
        .filter(F.col("grade").isNotNull() & F.col("weight").isNotNull())
        .groupBy("year_of_matriculation", "grade")
        .agg(
            F.sum(F.col("weight") * F.col("copies")).alias("weight"),
            F.sum(F.col("catalogue_credits") * F.col("copies")).alias("credits"),
        )
    )
    grade = F.col("grade")
    return per_cohort.groupBy("year_of_matriculation").agg(
        r(mean_grade(F.sum(tenths(grade) * F.col("credits")), F.sum("credits")), 2).alias("weighted_avg_grade"),
        F.percentile(grade, 0.5, F.col("weight")).alias("median_grade"),
    )


def cohort_kpi(summary: DataFrame, students: DataFrame) -> DataFrame:
    """One row per intake year, from one row per student; the attempts are not read again."""
    per_student = students.groupBy("student_id", "year_of_matriculation").agg(
        F.max("inactivity_flag").alias("inactive"), F.count("*").alias("copies")
    )
    reached = per_student.join(summary, "student_id", "left")
    on_track = F.filter("terms", lambda one: F.abs(one["credits"] * F.col("copies") - TERM_CREDITS) <= TOLERANCE)
    rates = reached.groupBy("year_of_matriculation").agg(
        F.count("student_id").alias("enrollments"),
        F.sum(flag(F.col("degree"))).alias("degrees"),
        F.sum(flag(F.coalesce("failed_for_good", F.lit(False)) | F.col("inactive"))).alias("dropouts"),
        r(F.sum("failed_attempts") / F.nullif(F.count("failed_attempts"), F.lit(0)), 2).alias("avg_failed_attempts"),
        F.sum(F.when(F.col("terms").isNotNull(), F.size(on_track))).alias("ontrack_terms"),
        F.sum(F.when(F.col("terms").isNotNull(), F.size("terms"))).alias("total_terms"),
    )
    year = "year_of_matriculation"
    return (
        rates.join(cohort_grades(reached), year, "left")
        .select(
            F.col(year).alias("intake_year"),
            "enrollments",
            percent(F.col("degrees"), F.col("enrollments")).alias("graduation_rate"),
            percent(F.col("dropouts"), F.col("enrollments")).alias("dropout_rate"),
            "weighted_avg_grade",
            "median_grade",
            "avg_failed_attempts",
            percent(F.col("ontrack_terms"), F.col("total_terms")).alias("ontrack_rate"),
        )
        .orderBy("intake_year")
    )
