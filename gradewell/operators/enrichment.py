"""Silver enrichment: curriculum match, credits, tries and withdrawals per attempt.

Everything that depends on the other attempts of a student in a module is
computed on *cells* (student, module, term), which an ordinary aggregate with
map-side combine produces.  A (student, module) group has at most ``MAX_TERMS``
cells, so the windows stay tiny even when one student or module owns a third of
all attempts; the attempts themselves are only joined back to their cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions import rules
from gradewell.functions.numeric import flag
from gradewell.operators.skew import LOOKUP_ROWS, ROWS_PER_TASK, hot_groups, hot_keys, join_lookup, join_split, running_total

CELL = ["student_id", "module_number", "term_counter"]
NO_MATCH = 3


def has_status(status: str) -> Column:
    return F.coalesce(F.col("exam_status") == status, F.lit(False))


# --- curriculum match --------------------------------------------------------

MATCH_FIELDS = ("module_title", "module_acronym", "credits", "recommended_semester", "module_key")


def match_quality(same_field: Column, same_year: Column, same_semester: Column) -> Column:
    """0 field, year and semester agree; 1 year and semester; 2 year; 3 otherwise."""
    return (
        F.when(same_year & same_semester & same_field, 0).when(same_year & same_semester, 1).when(same_year, 2)
        .otherwise(NO_MATCH)
    )


def curriculum_matches(modules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Best curriculum row for every student situation, from the catalogue alone.

    A situation is a module, one of two regulations and one of two starting
    semesters.  The score of a row depends on the student's field only through
    equality, so the best row for field f is the smaller of the best row *of* f
    and the best row of any field scored as foreign.  Returns the table keyed
    with the field and the one for fields the module does not list; together at
    most eight rows per catalogue row, whatever the number of attempts.
    """
    situations = F.array(
        *[
            F.struct(F.lit(y).alias("study_regulations_year"), F.lit(s).alias("semester_of_matriculation"))
            for y in t.REGULATIONS
            for s in t.SEMESTERS
        ]
    )
    candidates = modules.filter(F.col("module_id").isNotNull()).withColumn("situation", F.explode(situations)).select(
        "*", "situation.*"
    )
    same_year = F.coalesce(F.col("graduation_year") == F.col("study_regulations_year"), F.lit(False))
    same_semester = F.coalesce(F.col("graduation_semester") == F.col("semester_of_matriculation"), F.lit(False))

    def ranked(own_field: bool) -> Column:
        """The candidate as a struct whose smallest value is the preferred match."""
        return F.struct(
            match_quality(F.lit(own_field), same_year, same_semester).alias("score"),
            F.lit(0 if own_field else 1).alias("foreign"),
            F.col("graduation_year").isNull().alias("no_year"),
            "graduation_year",
            F.col("graduation_semester").isNull().alias("no_semester"),
            "graduation_semester",
            F.col("field_of_study").alias("match_field"),
            *MATCH_FIELDS,
        )

    situation = ["module_id", "study_regulations_year", "semester_of_matriculation"]
    foreign = candidates.groupBy(*situation).agg(F.min(ranked(False)).alias("best"))
    own = (
        candidates.filter(F.col("field_of_study").isNotNull())
        .groupBy(*situation, F.col("field_of_study").cast("bigint").alias("field_of_study"))
        .agg(F.min(ranked(True)).alias("own"))
        .join(foreign, situation)
        .select(*situation, "field_of_study", F.least("own", "best").alias("best"))
    )

    def flat(table: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        quality = F.when(F.col("best.module_title").isNull(), NO_MATCH).otherwise(F.col("best.score"))
        return table.select(
            F.col("module_id").alias("module_number"),
            *keys,
            quality.alias(f"{prefix}_quality"),
            *[F.col(f"best.{name}").alias(f"{prefix}_{name}") for name in MATCH_FIELDS],
        )

    return flat(own, [*situation[1:], "field_of_study"], "own"), flat(foreign, situation[1:], "any")


def best_module_match(
    rows: DataFrame, modules: DataFrame, lookup_rows: int = LOOKUP_ROWS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Attach the closest curriculum row; every input row comes back once.

    The match tables follow the curriculum, not the attempts: as a rule Spark
    broadcasts them by its own size check.  Beyond ``lookup_rows`` attempts of a
    hot module are spread over several tasks.
    """
    own, foreign = curriculum_matches(modules)
    situation = ["module_number", "study_regulations_year", "semester_of_matriculation"]
    joined = join_lookup(rows, foreign, situation, "attempt_id", "left", lookup_rows, rows_per_task)
    joined = join_lookup(joined, own, [*situation, "field_of_study"], "attempt_id", "left", lookup_rows, rows_per_task)
    listed = F.col("own_quality").isNotNull()

    def chosen(name: str) -> Column:
        return F.when(listed, F.col(f"own_{name}")).otherwise(F.col(f"any_{name}"))

    return joined.select(
        *[joined[c] for c in rows.columns],
        *[chosen(name).alias(name) for name in MATCH_FIELDS],
        F.coalesce(chosen("quality"), F.lit(NO_MATCH)).alias("match_quality"),
    )


# --- attempts of a student in a module ---------------------------------------


def attempt_cells(clean: DataFrame) -> DataFrame:
    """Attempts per student, module and term with the first id of each status."""

    def first_id(status: str) -> Column:
        return F.min(F.when(has_status(status), F.col("attempt_id")))

    return clean.groupBy(*CELL).agg(
        F.count_if(has_status(t.PASSED)).alias("passes"),
        first_id(t.PASSED).alias("first_pass_id"),
        first_id(t.FAILED).alias("first_fail_id"),
        first_id(t.WITHDRAWN).alias("first_withdrawal_id"),
    )


def student_state(students: DataFrame) -> DataFrame:
    """Graduation per dimension row, the rows of a student numbered."""
    number = F.row_number().over(Window.partitionBy("student_id").orderBy("field_of_study"))
    return students.select("student_id", "graduation_flag", number.alias("copy"))


def cell_history(clean: DataFrame, students: DataFrame) -> DataFrame:
    """Per cell: what happened to the student in the module before and in this term.

    Joining the student dimension here repeats a cell for every dimension row of
    its student, which is what joining it to the attempts would do to them.
    """
    order = Window.partitionBy("student_id", "module_number", "copy").orderBy("term_counter")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")

    def terms_before(first_id: str) -> Column:
        return F.coalesce(F.sum(flag(F.col(first_id).isNotNull())).over(earlier), zero)

    cells = attempt_cells(clean).join(student_state(students), "student_id")
    known = cells.select(
        "*",
        F.max("term_counter").over(whole).alias("last_term"),
        (F.sum("passes").over(whole) == 0).alias("never_passed"),
        F.coalesce(F.sum("passes").over(earlier), zero).alias("passes_before"),
        terms_before("first_withdrawal_id").alias("withdrawals_before"),
    )
    last_pass = F.when(F.col("term_counter") == F.col("last_term"), F.col("first_pass_id"))
    return known.withColumn("first_counted_id", F.least("first_fail_id", last_pass)).select(
        *CELL,
        "copy",
        "graduation_flag",
        "last_term",
        "never_passed",
        F.when(F.col("passes_before") == 0, F.col("first_pass_id")).alias("credit_id"),
        "first_counted_id",
        "first_withdrawal_id",
        terms_before("first_counted_id").alias("tries_before"),
        "withdrawals_before",
    )


def reached(row_id: str, first_id: str) -> Column:
    """1 once the first such attempt of the term has been seen, else 0."""
    return flag(F.col(row_id) >= F.col(first_id)).cast("bigint")


def should_count_try() -> Column:
    """A failure, or a pass in the last term the student took the module."""
    return has_status(t.FAILED) | (has_status(t.PASSED) & (F.col("term_counter") == F.col("last_term")))


def tries_count() -> Column:
    return F.col("tries_before") + reached("attempt_id", "first_counted_id")


def withdrawal_count() -> Column:
    return F.col("withdrawals_before") + reached("attempt_id", "first_withdrawal_id")


def credits_earned() -> Column:
    """Catalogue credits of the first pass, only for an exact curriculum match."""
    awarded = (F.col("attempt_id") == F.col("credit_id")) & (F.col("copy") == 1) & (F.col("match_quality") == 0)
    return F.coalesce(F.when(awarded, F.col("credits")), F.lit(0))


def exam_plan_dif() -> Column:
    """Terms between taking and planned semester, for exactly matched passes."""
    counts = has_status(t.PASSED) & (F.col("match_quality") == 0)
    return F.when(counts, F.col("term_counter") - F.col("recommended_semester"))


def module_not_in_plan() -> Column:
    return F.col("match_quality") != 0


def core_module_sanity() -> Column:
    """A graduate who never passed this regular module."""
    return F.col("graduation_flag") & ~F.col("module_number").isin(*t.PLACEHOLDERS) & F.col("never_passed")


def hot_attempts(
    clean: DataFrame, keys: list[str], hot_students: DataFrame | None, total: Column | None, rows_per_task: int
) -> DataFrame:
    """Hot groups of attempts; the hot students are counted here unless given with the row total."""
    if hot_students is None:
        counted = clean.groupBy("student_id").agg(F.count("*").alias("n_rows"))
        total = counted.agg(F.sum("n_rows")).scalar()
        hot_students = hot_keys(counted, ["student_id"], total, rows_per_task)
    return hot_groups(clean, keys, hot_students, "student_id", total, rows_per_task)


def attach_history(
    clean: DataFrame, students: DataFrame, hot_students: DataFrame | None = None, total: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join every attempt with the history of its cell, hot cells spread over tasks.

    A hot cell lies in a hot student: where none is given, attempts that lie by student meet their cells without being moved.
    """
    history = cell_history(clean, students)
    if hot_students is not None and hot_students.isEmpty():
        rows = clean.join(history.hint("merge"), CELL)
    else:
        hot = hot_attempts(clean, CELL, hot_students, total, rows_per_task)
        rows = join_split(clean, history, CELL, hot, "attempt_id")
    return rows.withColumn("study_regulations_year", rules.regulations_year(F.col("year_of_matriculation")))


def enriched_attempts(
    clean: DataFrame, students: DataFrame, modules: DataFrame, hot_students: DataFrame | None = None,
    total: Column | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Attempts with match and history columns, before the final projection."""
    return best_module_match(attach_history(clean, students, hot_students, total, rows_per_task), modules)


def stg_students_with_credits(
    clean: DataFrame, students: DataFrame, modules: DataFrame, hot_students: DataFrame | None = None,
    total: Column | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The enriched staging table: nineteen columns and the attempt id."""
    return enriched_attempts(clean, students, modules, hot_students, total, rows_per_task).select(
        "student_id",
        "module_number",
        F.col("grade_numeric").alias("grade"),
        "exam_status",
        "semester_type",
        "year",
        "exam_annotation",
        "term_counter",
        "module_title",
        "module_acronym",
        "module_key",
        credits_earned().alias("credits_earned"),
        exam_plan_dif().alias("exam_plan_dif"),
        module_not_in_plan().alias("module_not_in_plan"),
        "match_quality",
        core_module_sanity().alias("sanity_check"),
        tries_count().alias("tries_count"),
        withdrawal_count().alias("withdrawal_count"),
        rules.term_date(F.col("year"), F.col("semester_type")).alias("term_date"),
        "attempt_id",
    )


def running_pass_count(
    clean: DataFrame, hot_students: DataFrame | None = None, total: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Passes of the student in the module up to and including each attempt."""
    rows = clean.select(*CELL, "attempt_id", "exam_status")
    hot = hot_attempts(clean, CELL, hot_students, total, rows_per_task)
    passes = flag(has_status(t.PASSED))
    return running_total(rows, CELL[:2], CELL[2], "attempt_id", passes, "passed_so_far", hot)


# --- documented alternative of the credit rule --------------------------------


def credits_awarded_conceptual(
    clean: DataFrame, modules: DataFrame, hot_students: DataFrame | None = None, total: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK, lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Catalogue credits once per student and module, at the first passed or recognised attempt.

    Attempts meet every catalogue row of their module, as the join on the module
    number alone prescribes (the result has attempts times catalogue rows of their
    module, about twelve rows an attempt); the credits go to the first of these copies.
    """
    group = ["student_id", "module_number"]
    eligible = has_status(t.PASSED) | F.coalesce(F.col("exam_annotation") == "anerkannt", F.lit(False))
    term = F.coalesce("year", F.lit(99)) * 10 + F.when(F.col("semester_type") == t.SUMMER, 1).when(
        F.col("semester_type") == t.WINTER, 2
    ).otherwise(9)
    rows = clean.withColumn("eligible", eligible).withColumn("chronological", F.struct(term.alias("term"), "attempt_id"))
    first = rows.groupBy(*group).agg(F.min(F.when(F.col("eligible"), F.col("chronological"))).alias("first_eligible"))
    hot = hot_attempts(clean, group, hot_students, total, rows_per_task)
    rows = join_split(rows, first, group, hot, "attempt_id")

    in_module = Window.partitionBy("module_id").orderBy(
        F.col("module_key").asc_nulls_last(), F.col("module_title").asc_nulls_last(), F.col("credits").asc_nulls_last()
    )
    catalogue = modules.select(
        F.col("module_id").alias("module_number"), "module_title", "credits", F.row_number().over(in_module).alias("entry")
    )
    awarded = (F.col("chronological") == F.col("first_eligible")) & (F.coalesce("entry", F.lit(1)) == 1)
    return join_lookup(rows, catalogue, ["module_number"], "attempt_id", "left", lookup_rows, rows_per_task).select(
        "student_id",
        "module_number",
        "module_title",
        "semester_type",
        "year",
        "exam_status",
        "exam_annotation",
        "grade_numeric",
        F.col("credits").alias("credits_catalog"),
        F.coalesce(F.when(awarded, F.col("credits")), F.lit(0)).alias("credits_awarded"),
        "field_of_study",
        "attempt_id",
    )
