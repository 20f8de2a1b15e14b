"""KPI views that exist as documented definitions beside the tables.

They join attempts with every catalogue row of the module.  Attempts are counted
per module, status and grade first (a few thousand rows at any size) and take
the catalogue multiplicity as a weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag, mean_grade, percent, r, ratio, tenths
from gradewell.operators.summary import catalogue_weights


def _decided(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("exam_status").isin(t.PASSED, t.FAILED)).withColumnRenamed("module_number", "module_id")


def _outcome_counts(attempts: DataFrame, *keys: str) -> DataFrame:
    return attempts.groupBy(*keys, "module_id", "exam_status", "grade").agg(F.count("*").alias("n"))


def _rates(weighted: DataFrame, *keys: str) -> DataFrame:
    """Module count, pass and fail rate, weighted mean and median of passed grades."""
    passed = F.col("exam_status") == t.PASSED
    weight, credits = F.col("n") * F.col("n_rows"), F.col("n") * F.col("credit_sum")
    totals = weighted.groupBy(*keys).agg(
        F.count_distinct("module_id").alias("gesamt_anzahl_module"),
        F.sum(F.when(passed, weight).otherwise(0)).alias("passed"),
        F.sum(weight).alias("all"),
        F.sum(tenths(F.col("grade")) * credits).alias("points"),
        F.sum(F.when(passed, credits).otherwise(0)).alias("credits"),
    )
    medians = (
        weighted.filter(passed)
        .groupBy(*keys)
        .agg(F.percentile(F.col("grade").cast("double"), 0.5, weight).alias("median_note"))
    )
    if keys:
        totals = totals.join(medians, list(keys), "left")
    else:
        totals = totals.withColumn("median_note", medians.scalar())
    return totals.select(
        *keys,
        "gesamt_anzahl_module",
        percent(F.col("passed"), F.col("all")).alias("bestehensquote_prozent"),
        percent(F.col("all") - F.col("passed"), F.col("all")).alias("durchfallquote_prozent"),
        r(mean_grade(F.col("points"), F.col("credits")), 2).alias("durchschnittsnote_gewichtet"),
        "median_note",
    )


RATE_COLUMNS = (
    "gesamt_anzahl_studierende", "gesamt_anzahl_module", "bestehensquote_prozent",
    "durchfallquote_prozent", "durchschnittsnote_gewichtet", "median_note",
)


def _catalogued(attempts: DataFrame, modules: DataFrame) -> DataFrame:
    return attempts.join(modules.select("module_id").distinct(), "module_id", "left_semi")


def jahrgang_kpi_view(enriched: DataFrame, modules: DataFrame) -> DataFrame:
    """Rates per exam year."""
    attempts = _decided(enriched)
    rates = _rates(_outcome_counts(attempts, "year").join(catalogue_weights(modules), "module_id"), "year")
    students = (
        _catalogued(attempts, modules).select("year", "student_id").distinct()
        .groupBy("year").agg(F.count("student_id").alias("gesamt_anzahl_studierende"))
    )
    return rates.join(students, "year").select("year", *RATE_COLUMNS).orderBy("year")


def studienrichtung_kpi_view_v1(enriched: DataFrame, clean: DataFrame, modules: DataFrame) -> DataFrame:
    """Rates per field of study of the catalogue row."""
    weights = modules.groupBy("module_id", "field_of_study").agg(
        F.count("*").alias("n_rows"), F.sum("credits").alias("credit_sum")
    )
    rates = _rates(_outcome_counts(_decided(enriched)).join(weights, "module_id"), "field_of_study")
    students = (
        clean.select(F.col("field_of_study").cast("int"), "student_id").distinct()
        .groupBy("field_of_study").agg(F.count("student_id").alias("gesamt_anzahl_studierende"))
    )
    return rates.join(students, "field_of_study", "left").fillna(0, ["gesamt_anzahl_studierende"]).select(
        "field_of_study", *RATE_COLUMNS
    )


def studiengang_kpi_view(enriched: DataFrame, modules: DataFrame) -> DataFrame:
    """Rates of the whole programme, one row."""
    attempts = _decided(enriched)
    rates = _rates(_outcome_counts(attempts).join(catalogue_weights(modules), "module_id"))
    students = _catalogued(attempts, modules).select("student_id").distinct().agg(F.count("student_id"))
    return rates.withColumn("gesamt_anzahl_studierende", students.scalar()).select(*RATE_COLUMNS)


def _shares(passed: Column, attempts: Column) -> tuple[Column, Column]:
    """Share of passes and of other attempts in percent."""
    return r(ratio(passed, attempts) * 100, 2), r(ratio(attempts - passed, attempts) * 100, 2)


def student_kpi_view_v1(fact: DataFrame) -> DataFrame:
    """Rates per student over attempts; the tries counter is the attempt number."""
    per_module = fact.groupBy("student_id", "module_id").agg(
        F.sum("passed_flag").alias("passed"),
        F.sum(flag(F.col("tries_count") > 1)).alias("repeated"),
        F.count("*").alias("attempts"),
    )
    totals = per_module.groupBy("student_id").agg(
        F.count("module_id").alias("module_gesamt"),
        *[F.sum(c).alias(c) for c in ("passed", "repeated", "attempts")],
    )
    passed, failed = _shares(F.col("passed"), F.col("attempts"))
    return totals.select(
        "student_id",
        "module_gesamt",
        passed.alias("bestehensrate_je_student"),
        failed.alias("nichtbestehensrate_je_student"),
        percent(F.col("repeated"), F.col("attempts")).alias("wiederholungsrate_je_student"),
    )


def modul_kpi_view_v1(fact: DataFrame, modules: DataFrame) -> DataFrame:
    """Rates per module and title; a rate without any counted attempt is missing."""
    first_try = (F.col("tries_count") == 1) & (F.col("passed_flag") == 1)
    per_student = fact.groupBy("module_id", "student_id").agg(
        F.sum("passed_flag").alias("passed"),
        F.sum(F.when(first_try, 1)).alias("first_try"),
        F.sum(F.when(F.col("tries_count") > 1, 1)).alias("repeated"),
        F.count("*").alias("attempts"),
    )
    totals = per_student.groupBy("module_id").agg(
        F.count("student_id").alias("total_students"),
        *[F.sum(c).alias(c) for c in ("passed", "first_try", "repeated", "attempts")],
    )
    passed, failed = _shares(F.col("passed"), F.col("attempts"))
    titles = modules.select("module_id", "module_title").distinct()
    return totals.join(titles, "module_id").select(
        "module_id",
        "module_title",
        passed.alias("bestehensrate"),
        failed.alias("nichtbestehensrate"),
        percent(F.col("first_try"), F.col("attempts")).alias("first_try_rate"),
        percent(F.col("repeated"), F.col("attempts")).alias("wiederholungsrate"),
        "total_students",
    )


def studienrichtung_kpi_view(fact: DataFrame, students: DataFrame, modules: DataFrame) -> DataFrame:
    """Pass rate and graduates per field of study, over attempts times catalogue rows."""
    per_student = fact.groupBy("student_id", "module_id").agg(
        F.count("*").alias("attempts"), F.sum("passed_flag").alias("passed")
    )
    weighted = per_student.join(catalogue_weights(modules), "module_id").select(
        "student_id", "module_id",
        (F.col("attempts") * F.col("n_rows")).alias("attempts"),
        (F.col("passed") * F.col("n_rows")).alias("passed"),
    )
    attributes = students.select("student_id", "field_of_study", "graduation_flag")
    per_module = (
        weighted.join(attributes, "student_id")
        .groupBy("field_of_study", "module_id")
        .agg(
            F.sum("attempts").alias("attempts"),
            F.sum("passed").alias("passed"),
            F.sum(F.when(F.col("graduation_flag"), F.col("attempts")).otherwise(0)).alias("graduated"),
        )
    )
    totals = per_module.groupBy("field_of_study").agg(
        F.count("module_id").alias("gesamtmodule"), *[F.sum(c).alias(c) for c in ("attempts", "passed", "graduated")]
    )
    pass_share = ratio(F.col("passed"), F.col("attempts"))
    return totals.select(
        "field_of_study",
        r(pass_share * 100, 2).alias("bestehensquote"),
        r((1 - pass_share) * 100, 2).alias("durchfallquote"),
        F.col("passed").alias("bestandene_module"),
        "gesamtmodule",
        r(ratio(F.col("graduated"), F.col("attempts")) * 100, 2).alias("abschlussquote"),
    )
