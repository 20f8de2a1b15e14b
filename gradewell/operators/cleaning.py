"""Silver cleaning: raw exam attempts to one canonical row per attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.operators.skew import ROWS_PER_TASK, hot_keys, join_spread


def filter_main_grades(students: DataFrame) -> DataFrame:
    """Drop partial examinations and unnamed records; the filter reaches the scan."""
    return students.filter(rules.is_main_grade(F.col("Modul")))


def map_module_number(students: DataFrame) -> DataFrame:
    return students.withColumn("module_number", rules.module_number(F.col("Modulnummer"), F.col("Modul")))


def with_grades(students: DataFrame) -> DataFrame:
    return students.withColumn("grade", rules.clean_grade(F.col("Note"))).withColumn(
        "grade_numeric", rules.grade_numeric(F.col("grade"))
    )


def derive_exam_status(students: DataFrame) -> DataFrame:
    """Needs the columns of :func:`with_grades`."""
    status = rules.exam_status(F.col("Note"), F.col("Vermerk"), F.col("grade"), F.col("grade_numeric"))
    return students.withColumn("exam_status", status)


def with_term(students: DataFrame) -> DataFrame:
    return students.withColumn("semester_type", rules.semester(F.col("Semester"))).withColumn(
        "year", rules.exam_year(F.col("Jahr"))
    )


def clean_remark(students: DataFrame) -> DataFrame:
    return students.withColumn("exam_annotation", rules.clean_remark(F.col("Note"), F.col("Vermerk")))


def drop_undated(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("year").isNotNull() & F.col("semester_type").isNotNull())


ENUM_DOMAINS = {"exam_status": t.EXAM_STATUS, "semester_type": t.SEMESTERS, "exam_annotation": t.REMARKS}


def valid_enums() -> Column:
    """True where every coded column is NULL or in its domain."""
    return _all(rules.in_domain(F.col(c), d) for c, d in ENUM_DOMAINS.items())


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def cast_enums(rows: DataFrame) -> DataFrame:
    """Validate the coded columns; a value outside its domain stops the job."""
    return rows.withColumns({c: rules.checked(F.col(c), d, c) for c, d in ENUM_DOMAINS.items()})


def split_enum_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose codes are valid, and the rejected rest."""
    return rows.filter(valid_enums()), rows.filter(~valid_enums())


def enum_usage(rows: DataFrame) -> DataFrame:
    """Every label of every domain with its position and its number of rows."""
    counts = rows.agg(
        *[F.count_if(F.col(c) == label).alias(f"{c}:{label}") for c, domain in ENUM_DOMAINS.items() for label in domain]
    )
    labels = [
        F.struct(
            F.lit(c).alias("enum"), F.lit(label).alias("label"), F.lit(position).alias("position"),
            F.col(f"`{c}:{label}`").alias("n_rows"),
        )
        for c, domain in ENUM_DOMAINS.items()
        for position, label in enumerate(domain)
    ]
    return counts.select(F.inline(F.array(*labels)))


CLEAN_COLUMNS = (
    "attempt_id", "student_id", "module_number", "field_of_study", "grade", "grade_numeric",
    "exam_status", "semester_type", "year", "exam_annotation",
)


def unchecked_rows(students: DataFrame) -> DataFrame:
    """All row-local rules in one narrow pass (no shuffle); codes are cleaned but not checked yet."""
    rows = map_module_number(filter_main_grades(students))
    rows = clean_remark(with_term(derive_exam_status(with_grades(rows))))
    return drop_undated(
        rows.withColumnsRenamed({"studentID": "student_id", "Studienrichtung": "field_of_study"}).select(*CLEAN_COLUMNS)
    )


def clean_rows(students: DataFrame, on_invalid: str = "raise") -> DataFrame:
    """Cleaned rows with valid codes.

    ``on_invalid='raise'`` stops at a code outside its domain; with ``'reject'`` such rows are missing here and are
    the second half of :func:`split_rows`, so none is lost.
    """
    return cast_enums(unchecked_rows(students)) if on_invalid == "raise" else split_rows(students)[0]


def split_rows(students: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows with valid codes, and those with a code outside its domain."""
    return split_enum_rejects(unchecked_rows(students))


def student_profile(rows: DataFrame) -> DataFrame:
    """What the attempts of a student say about the student, one row each.

    Terms are kept as one bit per possible term (``MAX_TERMS`` of them fit a
    bigint), so the state per student is constant and the count of terms up to
    some term is a bit count.  The primary field is the most frequent field of
    the attempts with a known module, the smallest one on a tie.
    """
    index = rules.term_index(F.col("year"), F.col("semester_type"))
    known = ~F.col("module_number").isin(*t.PLACEHOLDERS)
    by_field = (
        rows.withColumn("term_index", index)
        .groupBy("student_id", "field_of_study")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(known).alias("n_known"),
            F.min("term_index").alias("first_term"),
            F.bit_or(F.expr(f"shiftleft(1L, cast(term_index - {t.FIRST_TERM_INDEX} as int))")).alias("term_bits"),
        )
    )
    votes = F.when(
        (F.col("n_known") > 0) & F.col("field_of_study").isNotNull(),
        F.struct("n_known", (-F.col("field_of_study")).alias("tie")),
    )
    return by_field.groupBy("student_id").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("first_term").alias("first_term"),
        F.bit_or("term_bits").alias("term_bits"),
        F.max_by("field_of_study", votes).alias("primary_field_of_study"),
    )


def hot_students(profile: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    return hot_keys(profile, ["student_id"], total_rows(profile), rows_per_task)


def total_rows(profile: DataFrame) -> Column:
    return profile.agg(F.sum("n_rows")).scalar()


def term_counter(index: Column, term_bits: Column) -> Column:
    """Number of different terms of the student up to this one (dense rank)."""
    up_to_here = F.call_function("shiftleft", F.lit(2).cast("bigint"), (index - t.FIRST_TERM_INDEX).cast("int")) - 1
    return F.bit_count(term_bits.bitwiseAND(up_to_here)).cast("bigint")


def matriculation_year(first_term: Column) -> Column:
    return F.floor((first_term - 1) / 2).cast("bigint")


def matriculation_semester(first_term: Column) -> Column:
    return F.when(first_term % 2 == 1, t.SUMMER).otherwise(t.WINTER)


def normalised_field(module_number: Column, own: Column, primary: Column) -> Column:
    """Placeholder modules take the student's primary field, others keep their own."""
    return F.when(module_number.isin(*t.PLACEHOLDERS), F.coalesce(primary, own)).otherwise(own)


def attach_profile(rows: DataFrame, profile: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add term counter, matriculation and normalised field to every attempt."""
    joined = join_spread(
        rows,
        profile.drop("n_rows"),
        ["student_id"],
        hot_students(profile, rows_per_task),
        "attempt_id",
    )
    index = rules.term_index(F.col("year"), F.col("semester_type"))
    return joined.select(
        "student_id",
        "module_number",
        "grade",
        "grade_numeric",
        "exam_status",
        "semester_type",
        "year",
        "exam_annotation",
        normalised_field(F.col("module_number"), F.col("field_of_study"), F.col("primary_field_of_study")).alias("field_of_study"),
        term_counter(index, F.col("term_bits")).alias("term_counter"),
        matriculation_year(F.col("first_term")).alias("year_of_matriculation"),
        matriculation_semester(F.col("first_term")).alias("semester_of_matriculation"),
        "attempt_id",
    )


def stg_students_clean(
    students: DataFrame, profile: DataFrame | None = None, on_invalid: str = "raise", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The cleaned staging table: twelve columns and the attempt id, one row per dated main grade."""
    rows = clean_rows(students, on_invalid)
    return attach_profile(rows, student_profile(rows) if profile is None else profile, rows_per_task)
