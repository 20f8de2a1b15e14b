"""KPI tables per module."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag, mean_grade, percent, r, ratio, tenths
from gradewell.operators.summary import FINAL_TRY


def module_mark_kpi(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("grade_numeric").isNotNull()).select("student_id", "module_id", "grade_numeric")


def module_status_kpi(fact: DataFrame) -> DataFrame:
    return fact.select("student_id", "module_id", "exam_status")


def module_boxplot_kpi(fact: DataFrame) -> DataFrame:
    """Quartiles and mean per module from the attempts per grade."""
    per_grade = fact.groupBy("module_id", "grade_numeric").agg(F.count("grade_numeric").alias("n"))
    grade, n = F.col("grade_numeric"), F.col("n")
    return per_grade.groupBy("module_id").agg(
        F.percentile(grade, 0.25, n).alias("first_quartile_grade"),
        F.percentile(grade, 0.75, n).alias("third_quartile_grade"),
        F.percentile(grade, 0.5, n).alias("median_grade"),
        r(mean_grade(F.sum(tenths(grade) * n), F.sum(n)), 2).alias("mean_grade"),
    )


def student_module_outcomes(fact: DataFrame) -> DataFrame:
    """What each student achieved in each module, as 0/1 columns and counts."""
    passed, failed = F.col("exam_status") == t.PASSED, F.col("exam_status") == t.FAILED
    first_try = (F.col("tries_count") == 1) & (F.col("passed_flag") == 1)
    return fact.groupBy("module_id", "student_id").agg(
        F.max(flag(passed)).alias("passed"),
        F.max(flag(failed)).alias("failed"),
        F.max(flag(failed & (F.col("tries_count") == FINAL_TRY))).alias("finally_failed"),
        F.max(flag(passed & (F.col("tries_count") == 1))).alias("first_try_passed"),
        F.sum(flag(~first_try)).alias("not_first_try"),
        F.count("*").alias("attempts"),
    )


def module_outcomes(fact: DataFrame) -> DataFrame:
    """Students by outcome per module; one exchange on (module, student), then partial sums."""
    return student_module_outcomes(fact).groupBy("module_id").agg(
        F.count("student_id").alias("total"),
        *[F.sum(c).alias(c) for c in ("passed", "failed", "finally_failed", "first_try_passed", "not_first_try", "attempts")],
    )


def _students_by(fact: DataFrame, outcome: str, name: str) -> DataFrame:
    """Modules with at least one such student."""
    return module_outcomes(fact).filter(F.col(outcome) > 0).select("module_id", F.col(outcome).alias(name))


def module_students_total(fact: DataFrame) -> DataFrame:
    return _students_by(fact, "total", "students_total")


def module_students_passed(fact: DataFrame) -> DataFrame:
    return _students_by(fact, "passed", "students_passed")


def module_students_failed(fact: DataFrame) -> DataFrame:
    return _students_by(fact, "failed", "students_failed")


def module_finally_failed(fact: DataFrame) -> DataFrame:
    """Students who failed on exactly the last permitted try."""
    return _students_by(fact, "finally_failed", "students_finally_failed")


def module_first_try_passed(fact: DataFrame) -> DataFrame:
    return _students_by(fact, "first_try_passed", "students_first_try_passed")


def students_clean_semester(fact: DataFrame) -> DataFrame:
    """Student terms in which every attempt passed on the first try."""
    return (
        fact.groupBy("time_id", "student_id")
        .agg(
            F.sum(flag(F.col("exam_status") != t.PASSED)).alias("not_passed"),
            F.sum(flag(F.col("tries_count") != 1)).alias("repeated"),
        )
        .filter((F.col("not_passed") == 0) & (F.col("repeated") == 0))
        .select("time_id", "student_id")
    )


def bottleneck(not_first_try: Column, attempts: Column) -> Column:
    """Share of attempts that were no pass on the first try."""
    return ratio(not_first_try, attempts)


def module_bottleneck(fact: DataFrame) -> DataFrame:
    return module_outcomes(fact).select(
        "module_id", bottleneck(F.col("not_first_try"), F.col("attempts")).alias("bottleneck_value")
    )


def module_exam_delay(enriched: DataFrame) -> DataFrame:
    """Mean deviation from the planned term; all module numbers, known or not."""
    return enriched.groupBy("module_number").agg(F.avg("exam_plan_dif").alias("avg_exam_plan_diff"))


def module_acronym(modules: DataFrame) -> DataFrame:
    return modules.groupBy("module_id").agg(F.min("module_acronym").alias("module_acronym"))


def modul_kpi(fact: DataFrame, enriched: DataFrame, modules: DataFrame) -> DataFrame:
    """One row per module taken.

    The failure percentage replaces a missing count by 0 above and by 1 below
    the fraction line, as the definition does.
    """
    delay = module_exam_delay(enriched).withColumnRenamed("module_number", "module_id")

    def or_one(name: str) -> Column:
        return F.when(F.col(name) == 0, 1).otherwise(F.col(name))

    return (
        module_outcomes(fact)
        .join(delay, "module_id")
        .join(module_acronym(modules), "module_id")
        .select(
            "module_id",
            "module_acronym",
            F.col("finally_failed").alias("students_finally_failed_count"),
            F.col("first_try_passed").alias("students_passed_first_try_count"),
            r(ratio(F.col("failed"), or_one("failed") + or_one("passed")) * 100, 2).alias("students_failed_percent"),
            r(ratio(F.col("finally_failed"), or_one("total")) * 100, 2).alias("students_final_fail_percent"),
            r(bottleneck(F.col("not_first_try"), F.col("attempts")), 2).alias("bottleneck_value"),
            r(F.col("avg_exam_plan_diff"), 2).alias("avg_exam_plan_diff"),
        )
        .orderBy("module_id")
    )
