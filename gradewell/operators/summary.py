"""One row per student with all that KPI tables of students, intakes and the programme need of the attempts.

Attempts are added up per (student, module, term, grade), with map-side combine, and moved by student once.  There every
cell gives a record for its term, one for its grade and one for its module, and these are added up where they are.  A
row holds at most ``MAX_TERMS`` terms and a few dozen grades, however many attempts a student has.

Stored in buckets of the student, sorted, the table is grouped and joined by student without moving it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag

FINAL_TRY = 3
NOT_PASSED_GRADE = 5
TERM, GRADE, MODULE = range(3)


def thesis_failed_for_good() -> Column:
    return (F.col("module_id") == t.THESIS) & (F.col("passed_flag") == 0) & (F.col("tries_count") >= FINAL_TRY)


def thesis_passed() -> Column:
    return (F.col("module_id") == t.THESIS) & (F.col("passed_flag") == 1)


def graded_thesis() -> Column:
    """A thesis with a grade other than the failing one."""
    return (F.col("module_id") == t.THESIS) & (F.col("grade_numeric") != NOT_PASSED_GRADE)


def catalogue_weights(modules: DataFrame) -> DataFrame:
    """Catalogue rows and credits per module: what a join on the module id multiplies by."""
    return modules.groupBy("module_id").agg(F.count("*").alias("n_rows"), F.sum("credits").alias("credit_sum"))


def cells(fact: DataFrame) -> DataFrame:
    """Attempts added up per student, module, term and grade."""
    passed, graded = F.col("passed_flag") == 1, F.col("grade_numeric").isNotNull()
    return fact.groupBy("student_id", "module_id", "term_counter", "grade_numeric").agg(
        F.count("*").alias("n"),
        F.sum("credits_earned").alias("credits"),
        F.sum(F.when(passed & graded, F.col("credits_earned"))).alias("passed_credits"),
        F.max(flag(passed)).alias("passed"),
        F.sum(flag(F.col("passed_flag") == 0)).alias("failed"),
        F.max(thesis_passed()).alias("degree"),
        F.max(F.coalesce(graded_thesis(), F.lit(False))).alias("graded_degree"),
        F.max(thesis_failed_for_good()).alias("failed_for_good"),
    )


def student_summary(fact: DataFrame, modules: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per student: thesis outcome, counts of modules and attempts, ``terms`` (term, credits) and ``grades`` (grade, attempts,
    credits, and both weighted with the catalogue rows of the modules)."""
    n, rows = F.col("n"), F.col("n_rows")
    weighted = cells(fact).join(catalogue_weights(modules), "module_id", "left").withColumns(
        {"weight": n * rows, "catalogue_credits": n * F.col("credit_sum"), "passed_weighted": F.col("passed_credits") * rows}
    )
    moved = weighted.repartition(buckets, "student_id") if buckets else weighted.repartition("student_id")

    def record(kind: int, **value: Column) -> Column:
        types = {"term": "bigint", "grade": "double", "module": "string"}
        keys = [value.get(name, F.lit(None)).cast(kind_of).alias(name) for name, kind_of in types.items()]
        return F.struct(F.lit(kind).alias("kind"), *keys)

    records = F.array(
        record(TERM, term=F.col("term_counter")), record(GRADE, grade=F.col("grade_numeric")), record(MODULE, module=F.col("module_id"))
    )
    sums = ("n", "credits", "failed", "weight", "catalogue_credits", "passed_weighted")
    most = ("passed", "degree", "graded_degree", "failed_for_good")
    parts = (
        moved.select("student_id", *sums, *most, F.inline(records))
        .groupBy("student_id", "kind", "term", "grade", "module")
        .agg(*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in most))
    )
    kind = F.col("kind")
    grade = F.struct("grade", "n", "credits", "weight", "catalogue_credits", "passed_weighted")
    return parts.groupBy("student_id").agg(
        *(F.max(c).alias(c) for c in ("degree", "graded_degree", "failed_for_good")),
        F.sum(F.when(kind == MODULE, F.col("failed"))).alias("failed_attempts"),
        F.sum(F.when(kind == MODULE, F.col("credits"))).alias("credits"),
        F.count_if(kind == MODULE).alias("modules"),
        F.sum(F.when(kind == MODULE, F.col("passed"))).alias("modules_passed"),
        F.count_if((kind == MODULE) & (n > 1)).alias("modules_repeated"),
        F.sort_array(F.collect_list(F.when(kind == TERM, F.struct("term", "credits")))).alias("terms"),
        F.sort_array(F.collect_list(F.when(kind == GRADE, grade))).alias("grades"),
    )


def grade_rows(summary: DataFrame, *keep: str) -> DataFrame:
    """One row per student and grade, with the columns ``keep`` of the summary."""
    return summary.select("student_id", *keep, F.inline("grades"))
