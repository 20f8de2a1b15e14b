"""KPIs of the whole programme, one row.

The definition multiplies attempts with catalogue rows and with all graduates.
Ratios, medians and distinct counts do not change under such a uniform
replication, so only the catalogue weights are applied; the two corner cases in
which the replication shows (no graduate, a single joined row) are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions.numeric import flag, mean_grade, percent, r, ratio, tenths
from gradewell.operators.summary import grade_rows, graded_thesis

STANDARD_TERMS = 4


def program_offtrack(progress: DataFrame) -> DataFrame:
    """Sum of the on-track flags and number of student terms.

    The column is called off-track by definition although it adds up the
    on-track flag; the rates below keep that.
    """
    return progress.agg(
        F.sum("ontrack_flag").alias("total_offtrack_semesters"), F.count("*").alias("total_semesters")
    )


def program_avg_terms(students: DataFrame) -> DataFrame:
    return students.filter("graduation_flag").agg(F.avg("terms_taken_total_count").alias("avg_terms_taken"))


def students_with_degree(fact: DataFrame) -> DataFrame:
    return fact.filter(graded_thesis()).select("student_id").distinct()


def students_in_standard_period(fact: DataFrame, students: DataFrame) -> DataFrame:
    in_time = students.filter(F.col("terms_taken_total_count") <= STANDARD_TERMS).select("student_id")
    return students_with_degree(fact).join(in_time, "student_id", "left_semi")


def weighted_grades(summary: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows, weights and credit-weighted sums per grade over the whole programme."""
    return (
        grade_rows(summary).filter(F.col("weight").isNotNull()).join(copies, "student_id")
        .groupBy(F.col("grade").alias("grade_numeric"))
        .agg(
            F.sum(F.col("weight") * F.col("copies")).alias("weight"),
            F.sum(F.col("passed_weighted") * F.col("copies")).alias("credits"),
        )
    )


def studiengang_kpi(summary: DataFrame, students: DataFrame, progress: DataFrame) -> DataFrame:
    """One row for the programme, from one row per student; the attempts are not read again."""
    listed = students.groupBy("student_id").agg(
        F.max("inactivity_flag").alias("inactive"),
        F.max(F.col("terms_taken_total_count") <= STANDARD_TERMS).alias("timely"),
        F.lit(True).alias("listed"),
        F.count("*").alias("copies"),
    )
    known = F.col("listed")
    counts = (
        summary.join(listed, "student_id", "left")
        .agg(
            F.count_if(known).alias("present"),
            F.sum(F.when(known, flag(F.col("degree")))).alias("degrees"),
            F.sum(F.when(known, flag(F.col("failed_for_good") | F.col("inactive")))).alias("dropouts"),
            F.count_if(F.col("graded_degree")).alias("graduates"),
            F.count_if(F.col("graded_degree") & F.col("timely")).alias("in_time"),
        )
    )
    grade, weight = F.col("grade_numeric"), F.col("weight")
    grades = weighted_grades(summary, listed.select("student_id", "copies")).agg(
        r(mean_grade(F.sum(tenths(grade) * F.col("credits")), F.sum(F.when(grade.isNotNull(), F.col("credits")))), 2).alias("mean"),
        F.percentile(grade, 0.5, F.when(grade.isNull(), 0).otherwise(weight)).alias("median"),
        F.sum(weight).alias("joined_rows"),
    )
    graduates, in_time = F.col("graduates"), F.col("in_time")
    off_track = program_offtrack(progress)
    terms_on, terms_all = off_track.select("total_offtrack_semesters").scalar(), off_track.select("total_semesters").scalar()

    def if_any(value: Column) -> Column:
        return F.when(graduates > 0, value)

    off = ratio(F.lit(100.0) * terms_on, terms_all)
    share = r(ratio(in_time, graduates) * 100, 2)
    return counts.select(
        F.lit("entire_program").alias("study_program_label"),
        F.coalesce(if_any(F.col("present")), F.lit(0)).cast("bigint").alias("students_total_count"),
        if_any(percent(F.col("degrees"), F.col("present"))).alias("graduation_rate"),
        if_any(percent(F.col("dropouts"), F.col("present"))).alias("dropout_rate"),
        if_any(grades.select("mean").scalar()).alias("weighted_avg_program_grade"),
        if_any(grades.select("median").scalar()).alias("median_program_grade"),
        r(off, 2).alias("offtrack_rate"),
        r(100 - off, 2).alias("ontrack_rate"),
        if_any(program_avg_terms(students).scalar()).alias("avg_terms_taken"),
        F.when(grades.select("joined_rows").scalar() * graduates != 1, share).alias("master_on_track_percent"),
    )
