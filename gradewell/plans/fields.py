"""KPI table per field of study and intake year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag, mean_grade, r, ratio
from gradewell.operators.summary import thesis_failed_for_good
from gradewell.plans.progress import passed_credits, passed_points

# Weights, in tenths, of this row and the two before it in the smoothed enrolments.
EWMA_TENTHS = (5, 3, 2)
KEYS = ("field_of_study", "year")


def enrolments_by_field_year(students: DataFrame) -> DataFrame:
    per_student = students.select("field_of_study", "year_of_matriculation", "student_id").distinct()
    return per_student.groupBy("field_of_study", "year_of_matriculation").agg(
        F.count("student_id").alias("matriculations_count")
    )


def student_years(fact: DataFrame, terms: DataFrame) -> DataFrame:
    """Activity, grades and thesis failure per student and calendar year.

    Summed before the student join, so that join sees at most one row per
    student and year instead of every attempt.  The sums per term are
    partitioned by student once, which the groupings and the join reuse.
    """
    per_term = fact.groupBy("student_id", "time_id").agg(
        F.max(F.coalesce(F.col("exam_status") != t.WITHDRAWN, F.lit(False))).alias("active"),
        F.max(thesis_failed_for_good()).alias("failed_for_good"),
        F.sum(passed_points()).alias("points"),
        F.sum(passed_credits()).alias("credits"),
    )
    return (
        per_term.join(F.broadcast(terms.select("time_id", "year")), "time_id")
        .repartition("student_id")
        .groupBy("student_id", "year")
        .agg(
            F.max("active").alias("active"),
            F.max("failed_for_good").alias("failed_for_good"),
            F.sum("points").alias("points"),
            F.sum("credits").alias("credits"),
        )
    )


def field_years(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    """Active students, dropouts and mean grade per field and year from one pass."""
    attributes = students.select("student_id", "field_of_study", "inactivity_flag")
    per_student = (
        student_years(fact, terms)
        .join(attributes, "student_id")
        .groupBy(*KEYS, "student_id")
        .agg(
            F.max(flag(F.col("active"))).alias("active"),
            F.max(flag(F.col("failed_for_good") | F.col("inactivity_flag"))).alias("dropout"),
            F.sum("points").alias("points"),
            F.sum("credits").alias("credits"),
        )
    )
    return per_student.groupBy(*KEYS).agg(
        F.sum("active").alias("active"),
        F.sum("dropout").alias("dropouts"),
        F.sum("points").alias("points"),
        F.sum("credits").alias("credits"),
    )


def _active_count() -> Column:
    """Active students, missing where there are none."""
    return F.nullif(F.col("active"), F.lit(0).cast("bigint"))


def _mean() -> Column:
    return r(mean_grade(F.col("points"), F.col("credits")), 2)


def _dropout_rate() -> Column:
    """Share of dropouts among the active students of the year; missing without dropouts."""
    return F.when(F.col("dropouts") > 0, r(ratio(F.col("dropouts"), _active_count()), 4))


def active_by_field_year(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    return field_years(fact, terms, students).filter(F.col("active") > 0).select(
        *KEYS, F.col("active").alias("students_active_count")
    )


def avg_grade_by_field_year(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    return field_years(fact, terms, students).select(*KEYS, _mean().alias("weighted_avg_grade_per_year"))


def dropouts_by_field_year(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    """Students without a way to the degree, for every year they have attempts in."""
    return (
        student_years(fact, terms)
        .join(students.select("student_id", "field_of_study", "inactivity_flag"), "student_id")
        .filter(F.col("failed_for_good") | F.col("inactivity_flag"))
        .select(*KEYS, "student_id")
        .distinct()
    )


def dropout_rate_by_field_year(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    return field_years(fact, terms, students).filter(F.col("dropouts") > 0).select(
        *KEYS, _dropout_rate().alias("dropout_rate")
    )


def _previous(offset: int) -> Column:
    """Enrolments of an earlier row of the field (a handful of years per field)."""
    order = Window.partitionBy("field_of_study").orderBy("year_of_matriculation")
    return F.lag("matriculations_count", offset).over(order)


def with_growth(enrolments: DataFrame) -> DataFrame:
    """Previous row's enrolments and the growth against it in percent."""
    count = F.col("matriculations_count").cast("double")
    previous = F.col("matriculations_prev_year_count")
    return enrolments.withColumn("matriculations_prev_year_count", _previous(1)).withColumn(
        "matriculations_growth_rate", r(ratio(count - previous, previous) * 100, 2)
    )


def with_ewma(enrolments: DataFrame) -> DataFrame:
    """Weighted mean of three rows and the deviation from it in percent."""
    count = F.col("matriculations_count")
    now, one, two = EWMA_TENTHS
    tenths = now * count + one * F.coalesce(_previous(1), count) + two * F.coalesce(_previous(2), count)
    smoothed = F.col("_tenths")
    return (
        enrolments.withColumn("_tenths", tenths)
        .withColumn("ewma_enrollments", r(smoothed / 10, 2))
        .withColumn("growth_rate_vs_ewma_percent", r(ratio(count * 10 - smoothed, smoothed) * 100, 2))
        .drop("_tenths")
    )


def with_regression(enrolments: DataFrame) -> DataFrame:
    """Least-squares line of enrolments over years per field; NULL for a single year."""
    field = Window.partitionBy("field_of_study")
    year = F.col("year_of_matriculation")
    slope = F.regr_slope("matriculations_count", "year_of_matriculation").over(field)
    intercept = F.regr_intercept("matriculations_count", "year_of_matriculation").over(field)
    return (
        enrolments.withColumn("_slope", slope)
        .withColumn("_intercept", intercept)
        .withColumn("regression_slope", r(F.col("_slope"), 3))
        .withColumn("regression_intercept", r(F.col("_intercept"), 3))
        .withColumn("regression_trend_value", r(F.col("_intercept") + F.col("_slope") * year, 3))
        .drop("_slope", "_intercept")
    )


def enrolment_growth(students: DataFrame) -> DataFrame:
    return with_growth(enrolments_by_field_year(students))


def enrolment_ewma(students: DataFrame) -> DataFrame:
    return with_ewma(enrolments_by_field_year(students))


def enrolment_regression(students: DataFrame) -> DataFrame:
    return with_regression(enrolments_by_field_year(students))


def studiengangsvergleich_kpi(fact: DataFrame, terms: DataFrame, students: DataFrame) -> DataFrame:
    basis = with_regression(with_ewma(with_growth(enrolments_by_field_year(students))))
    years = field_years(fact, terms, students).select(
        "field_of_study",
        F.col("year").alias("year_of_matriculation"),
        _active_count().alias("students_active_count"),
        _mean().alias("weighted_avg_grade_per_year"),
        _dropout_rate().alias("dropout_rate"),
    )
    return (
        basis.join(years, ["field_of_study", "year_of_matriculation"], "left")
        .select(
            "field_of_study",
            "year_of_matriculation",
            "matriculations_count",
            "matriculations_prev_year_count",
            "matriculations_growth_rate",
            "students_active_count",
            "weighted_avg_grade_per_year",
            "dropout_rate",
            "ewma_enrollments",
            "growth_rate_vs_ewma_percent",
            "regression_slope",
            "regression_intercept",
            "regression_trend_value",
        )
        .orderBy("field_of_study", "year_of_matriculation")
    )
