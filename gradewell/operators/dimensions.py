"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.functions.numeric import flag

INACTIVE_AFTER_TERMS = 8
DEGREE_CREDITS = 120
BONUS_PER_PLACEHOLDER = 5
ATTRIBUTES = ("student_id", "year_of_matriculation", "semester_of_matriculation", "study_regulations_year", "field_of_study")


def student_attributes(clean: DataFrame) -> DataFrame:
    """Distinct attributes; a student seen in two fields of study has two rows."""
    return clean.withColumn(
        "study_regulations_year", rules.regulations_year(F.col("year_of_matriculation"))
    ).select(*ATTRIBUTES).distinct()


def passed_thesis() -> Column:
    return (F.col("module_number") == t.THESIS) & (F.col("exam_status") == t.PASSED)


def degree_completion(clean: DataFrame) -> DataFrame:
    return clean.groupBy("student_id").agg(F.sum(flag(passed_thesis())).cast("bigint").alias("i707_pass_count"))


def term_totals(clean: DataFrame) -> DataFrame:
    return clean.groupBy("student_id").agg(F.max("term_counter").alias("terms_taken_total_count"))


def start_index(year: Column, semester_type: Column) -> Column:
    return rules.term_index(year, semester_type).cast("bigint")


def start_semester_index(attributes: DataFrame) -> DataFrame:
    index = start_index(F.col("year_of_matriculation"), F.col("semester_of_matriculation"))
    return attributes.select("student_id", index.alias("start_semester_index"))


def current_semester_index(clean: DataFrame) -> DataFrame:
    """The latest term in the data, one row."""
    return clean.agg(F.max(start_index(F.col("year"), F.col("semester_type"))).alias("current_semester_index"))


def graduation_flag(thesis_passes: Column) -> Column:
    return F.coalesce(thesis_passes, F.lit(0)) >= 1


def inactivity_flag(current: Column, start: Column, thesis_passes: Column) -> Column:
    return F.coalesce(current - start >= INACTIVE_AFTER_TERMS, F.lit(False)) & ~graduation_flag(thesis_passes)


def dim_students(clean: DataFrame) -> DataFrame:
    """One row per student and field of study.

    A student seen in k fields appears k times per field: the start-term join of
    the definition runs on the student alone.  One aggregate to (student, field)
    feeds everything; the window behind it sees one row per field code.
    """
    base = clean.withColumn(
        "study_regulations_year", rules.regulations_year(F.col("year_of_matriculation"))
    ).groupBy(*ATTRIBUTES).agg(
        F.sum(flag(passed_thesis())).alias("passes"),
        F.max("term_counter").alias("terms"),
    )
    student = Window.partitionBy("student_id")
    per_field = base.select(
        *ATTRIBUTES,
        F.sum("passes").over(student).alias("i707_pass_count"),
        F.max("terms").over(student).alias("terms_taken_total_count"),
        F.count("*").over(student).cast("int").alias("copies"),
    ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    current = current_semester_index(clean).scalar()
    start = start_index(F.col("year_of_matriculation"), F.col("semester_of_matriculation"))
    return per_field.select(
        *ATTRIBUTES,
        graduation_flag(F.col("i707_pass_count")).alias("graduation_flag"),
        "terms_taken_total_count",
        inactivity_flag(current, start, F.col("i707_pass_count")).alias("inactivity_flag"),
    )


def dim_modul(module: DataFrame) -> DataFrame:
    """One row per curriculum and module, so ``module_id`` repeats."""
    key = rules.module_key(F.col("AbJahr"), F.col("AbSemester"), F.col("Modulnummer"), F.col("Studienrichtung"))
    return module.select(
        F.col("Modulnummer").alias("module_id"),
        F.col("Modul").alias("module_title"),
        F.col("Acronym").alias("module_acronym"),
        F.col("Credits").alias("credits"),
        F.col("AbJahr").alias("graduation_year"),
        F.col("AbSemester").alias("graduation_semester"),
        key.alias("module_key"),
        F.col("Semester").alias("recommended_semester"),
        F.col("Studienrichtung").alias("field_of_study"),
        F.col("Art").alias("module_type"),
        F.col("Professor").alias("professor_name"),
        F.col("APL").alias("apl_flag"),
        F.col("`schriftliche Prüfung`").alias("written_flag"),
        F.col("`mündliche Prüfung`").alias("oral_flag"),
    )


def dim_zeit(enriched: DataFrame) -> DataFrame:
    """One row per term.  Numbered over at most ``MAX_TERMS`` rows, hence the plain global window."""
    terms = enriched.select("year", "semester_type").dropna().distinct()
    order = Window.orderBy(F.col("year"), rules.semester_order(F.col("semester_type")))
    return terms.select(
        F.row_number().over(order).cast("bigint").alias("time_id"),
        "year",
        "semester_type",
        rules.first_match((F.col("semester_type") == t.SUMMER, 1), (F.col("semester_type") == t.WINTER, 0)).alias("semester_type_numeric"),
        rules.term_date(F.col("year"), F.col("semester_type")).alias("time_label"),
    )


def dim_students_with_credits(enriched: DataFrame, students: DataFrame) -> DataFrame:
    """Students with credit totals and the plausibility check of graduates."""
    totals = enriched.groupBy("student_id").agg(
        F.sum("credits_earned").cast("int").alias("credits"),
        F.count_if(
            F.col("module_number").isin(t.ELECTIVE, t.ADDITIONAL) & (F.col("exam_status") == t.PASSED)
        ).cast("int").alias("placeholders"),
        F.max(flag(F.col("sanity_check"))).alias("core_failure"),
    )
    zero = F.lit(0)
    joined = students.join(totals, "student_id", "left").select(
        "student_id",
        "graduation_flag",
        "year_of_matriculation",
        "semester_of_matriculation",
        "study_regulations_year",
        "field_of_study",
        "terms_taken_total_count",
        F.coalesce("credits", zero).alias("credits_earned_total_count"),
        F.coalesce("placeholders", zero).alias("passed_xwm_xzm_count"),
        F.coalesce("core_failure", zero).alias("core_failure"),
    )
    with_bonus = joined.withColumn(
        "total_credits_with_xwm_xzm_bonus",
        (F.col("credits_earned_total_count") + F.col("passed_xwm_xzm_count") * BONUS_PER_PLACEHOLDER).cast("int"),
    )
    too_few = (F.col("credits_earned_total_count") < DEGREE_CREDITS) & (
        F.col("total_credits_with_xwm_xzm_bonus") < DEGREE_CREDITS
    )
    return with_bonus.withColumn(
        "sanity_check", F.col("graduation_flag") & ((F.col("core_failure") == 1) | too_few)
    ).drop("core_failure")
