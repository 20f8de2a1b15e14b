"""Queries of the engine over the driver's tables, and their DuckDB counterparts.

Every query reads the whole derived exam tables (``gradewell.sources.fixtures``)
or the event table of the given folder.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gradewell.functions import rules  # noqa: E402
from gradewell.operators import cleaning, dependencies, dimensions, enrichment, quality, streaks  # noqa: E402
from gradewell.oracle import oracle_sql as _oracle_sql  # noqa: E402
from gradewell.plans import checks, cohorts, documented_views, fields, modules, programme, progress, risk, students  # noqa: E402
from gradewell.plans.refresh import GrowingTables  # noqa: E402
from gradewell.plans.warehouse import INTERNAL, KPIS, LAYERS, Warehouse, fixture_warehouse  # noqa: E402
from gradewell.sources import fixtures, readers, sinks  # noqa: E402

SMOKE_FOLDER = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Study progress of every student, term by term."""
    return fixture_warehouse(spark, SMOKE_FOLDER).ref("study_progress_kpi")


def _on(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: build(fixture_warehouse(spark, folder))


def _events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(fixtures.read_source(spark, folder, "events"))


def _columns(name: str, *columns: str) -> Query:
    return _on(lambda w: w.ref(name).select(*columns))


# --- sources and sinks --------------------------------------------------------


def _scan_students(w: Warehouse) -> DataFrame:
    w.ref("students")
    return readers.read_students(w.spark, w.path("students"))


def _seed_module(w: Warehouse) -> DataFrame:
    """The curriculum written as CSV and read with the seed reader."""
    path = w.path("seed")
    w.ref("module").write.mode("overwrite").csv(path, header=True, encoding="UTF-8")
    return readers.read_module_seed(w.spark, path)


def _lookup_field(w: Warehouse) -> DataFrame:
    named = readers.with_field_name(w.ref("dim_students"), readers.fields_of_study(w.spark))
    return named.select("student_id", "field_of_study", "field_name")


def _ref(w: Warehouse) -> DataFrame:
    """Rows of every model reachable by name."""
    counts = [
        w.ref(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
        for name in (*LAYERS, *KPIS)
        if name not in INTERNAL
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _write_table(w: Warehouse) -> DataFrame:
    return sinks.write_table(w.ref("active_students_kpi"), w.path("copy"))


def _create_view(w: Warehouse) -> DataFrame:
    name = "gradewell_fact_view"
    sinks.create_view(w.ref("fact_kpi"), name)
    return w.spark.sql(f"SELECT exam_status, count(*) AS n_rows FROM {name} GROUP BY exam_status")


def _create_or_replace_table(w: Warehouse) -> DataFrame:
    name = "gradewell_progress"
    return sinks.create_or_replace_table(w.ref("study_progress_kpi"), name, w.path(name))


def _fact_kpi_incremental(w: Warehouse) -> DataFrame:
    """The fact after all records have come in two batches, the later one among students that are known."""
    buckets = max(w.spark.sparkContext.defaultParallelism, w.buckets // 4)  # each a file of all 16 parts
    tables = GrowingTables(w.spark, lambda: w.ref("module"), w.path("growing"), parts=16, buckets=buckets)
    late = F.pmod(F.xxhash64("attempt_id"), F.lit(4)) == 0
    tables.append(w.ref("students").filter(~late), "first")
    tables.append(w.ref("students").filter(late), "second")
    return tables.ref("fact_kpi")


SOURCES: dict[str, Query] = {
    "scan_students": _on(_scan_students),
    "seed_module": _on(_seed_module),
    "scan_student_ml": _on(lambda w: w.ref("student_ml")),
    "lookup_field": _on(_lookup_field),
    "ref": _on(_ref),
    "write_table": _on(_write_table),
    "create_view": _on(_create_view),
    "create_or_replace_table": _on(_create_or_replace_table),
    "fact_kpi_incremental": _on(_fact_kpi_incremental),
    "create_enum": _on(lambda w: cleaning.enum_usage(w.ref("stg_students_clean"))),
}

# --- cleaning -------------------------------------------------------------------


def _main(w: Warehouse) -> DataFrame:
    return cleaning.filter_main_grades(w.ref("students"))


def _graded(w: Warehouse) -> DataFrame:
    return cleaning.with_grades(_main(w))


def _profile(w: Warehouse, name: str, column) -> DataFrame:
    return w.ref("student_profile").select("student_id", column.alias(name))


CLEANING: dict[str, Query] = {
    "filter_main_grades": _on(_main),
    "map_module_number": _on(lambda w: cleaning.map_module_number(_main(w)).select("attempt_id", "module_number")),
    "clean_grade": _on(lambda w: _graded(w).select("attempt_id", "grade")),
    "grade_numeric": _on(lambda w: _graded(w).select("attempt_id", "grade_numeric")),
    "derive_exam_status": _on(lambda w: cleaning.derive_exam_status(_graded(w)).select("attempt_id", "exam_status")),
    "normalise_semester": _on(lambda w: cleaning.with_term(_main(w)).select("attempt_id", "semester_type")),
    "clean_year": _on(lambda w: cleaning.with_term(_main(w)).select("attempt_id", "year")),
    "clean_remark": _on(lambda w: cleaning.clean_remark(_main(w)).select("attempt_id", "exam_annotation")),
    "drop_undated": _on(
        lambda w: cleaning.drop_undated(cleaning.with_term(_main(w))).select("attempt_id", "year", "semester_type")
    ),
    "term_counter": _columns("stg_students_clean", "attempt_id", "term_counter"),
    "matriculation_year": _on(
        lambda w: _profile(w, "year_of_matriculation", cleaning.matriculation_year(F.col("first_term")))
    ),
    "matriculation_semester": _on(
        lambda w: _profile(w, "semester_of_matriculation", cleaning.matriculation_semester(F.col("first_term")))
    ),
    "primary_field": _on(lambda w: _profile(w, "primary_field_of_study", F.col("primary_field_of_study"))),
    "normalise_field": _columns("stg_students_clean", "attempt_id", "field_of_study"),
    "cast_enums": _on(
        lambda w: cleaning.cast_enums(cleaning.unchecked_rows(w.ref("students"))).select(
            "attempt_id", "exam_status", "semester_type", "exam_annotation"
        )
    ),
}

# --- dimensions -----------------------------------------------------------------


def _attributes(w: Warehouse) -> DataFrame:
    return dimensions.student_attributes(w.ref("stg_students_clean"))


DIMENSIONS: dict[str, Query] = {
    "student_attributes": _on(_attributes),
    "degree_completion": _on(lambda w: dimensions.degree_completion(w.ref("stg_students_clean"))),
    "term_totals": _on(lambda w: dimensions.term_totals(w.ref("stg_students_clean"))),
    "start_semester_index": _on(lambda w: dimensions.start_semester_index(_attributes(w))),
    "current_semester_index": _on(lambda w: dimensions.current_semester_index(w.ref("stg_students_clean"))),
    "graduation_flag": _on(
        lambda w: dimensions.degree_completion(w.ref("stg_students_clean")).select(
            "student_id", dimensions.graduation_flag(F.col("i707_pass_count")).alias("graduation_flag")
        )
    ),
    "inactivity_flag": _columns("dim_students", "student_id", "inactivity_flag"),
    "module_key": _columns("dim_modul", "module_id", "graduation_year", "graduation_semester", "field_of_study", "module_key"),
}

# --- enrichment -------------------------------------------------------------------


def _hot(w: Warehouse) -> dict:
    profile = w.ref("student_profile")
    return {
        "hot_students": cleaning.hot_students(profile, w.rows_per_task),
        "total": cleaning.total_rows(profile),
        "rows_per_task": w.rows_per_task,
    }


def _matched(w: Warehouse) -> DataFrame:
    rows = w.ref("stg_students_clean").withColumn(
        "study_regulations_year", rules.regulations_year(F.col("year_of_matriculation"))
    )
    return enrichment.best_module_match(rows, w.ref("dim_modul"))


def _should_count_try(w: Warehouse) -> DataFrame:
    rows = enrichment.attach_history(w.ref("stg_students_clean"), w.ref("dim_students"), **_hot(w))
    return rows.select("attempt_id", enrichment.should_count_try().alias("should_count_try"))


ENRICHMENT: dict[str, Query] = {
    "running_pass_count": _on(
        lambda w: enrichment.running_pass_count(w.ref("stg_students_clean"), **_hot(w)).select(
            "attempt_id", "student_id", "module_number", "term_counter", "passed_so_far"
        )
    ),
    "best_module_match": _on(
        lambda w: _matched(w).select(
            "attempt_id", "module_key", "module_title", "module_acronym", "credits", "recommended_semester"
        )
    ),
    "match_quality": _on(lambda w: _matched(w).select("attempt_id", "match_quality")),
    "should_count_try": _on(_should_count_try),
    **{
        name: _columns("stg_students_with_credits", "attempt_id", name)
        for name in ("credits_earned", "exam_plan_dif", "module_not_in_plan", "tries_count", "withdrawal_count", "term_date")
    },
    "core_module_sanity": _columns("stg_students_with_credits", "attempt_id", "sanity_check"),
    "credits_awarded_conceptual": _on(
        lambda w: enrichment.credits_awarded_conceptual(w.ref("stg_students_clean"), w.ref("dim_modul"), **_hot(w))
    ),
}

# --- KPI tables and their parts ------------------------------------------------------


def _fact(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda w: build(w.ref("fact_kpi")))


def _years(build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    return _on(lambda w: build(w.ref("fact_kpi"), w.ref("dim_zeit"), w.ref("dim_students")))


PARTS: dict[str, Query] = {
    "term_progress": _fact(progress.term_progress),
    "study_progress": _fact(progress.study_progress),
    "student_module_rollup": _fact(students.student_module_rollup),
    "student_grades": _fact(students.student_grades),
    "module_students_total": _fact(modules.module_students_total),
    "module_students_passed": _fact(modules.module_students_passed),
    "module_students_failed": _fact(modules.module_students_failed),
    "module_finally_failed": _fact(modules.module_finally_failed),
    "module_first_try_passed": _fact(modules.module_first_try_passed),
    "students_clean_semester": _fact(modules.students_clean_semester),
    "module_bottleneck": _fact(modules.module_bottleneck),
    "module_exam_delay": _on(lambda w: modules.module_exam_delay(w.ref("stg_students_with_credits"))),
    "module_acronym": _on(lambda w: modules.module_acronym(w.ref("dim_modul"))),
    "cohort_ontrack": _on(lambda w: cohorts.cohort_ontrack(w.ref("fact_kpi"), w.ref("dim_students"))),
    "program_offtrack": _on(lambda w: programme.program_offtrack(w.ref("study_progress_rows"))),
    "program_avg_terms": _on(lambda w: programme.program_avg_terms(w.ref("dim_students"))),
    "students_with_degree": _fact(programme.students_with_degree),
    "students_in_standard_period": _on(
        lambda w: programme.students_in_standard_period(w.ref("fact_kpi"), w.ref("dim_students"))
    ),
    "enrolments_by_field_year": _on(lambda w: fields.enrolments_by_field_year(w.ref("dim_students"))),
    "active_by_field_year": _years(fields.active_by_field_year),
    "avg_grade_by_field_year": _years(fields.avg_grade_by_field_year),
    "dropouts_by_field_year": _years(fields.dropouts_by_field_year),
    "dropout_rate_by_field_year": _years(fields.dropout_rate_by_field_year),
    "enrolment_growth": _on(lambda w: fields.enrolment_growth(w.ref("dim_students"))),
    "enrolment_ewma": _on(lambda w: fields.enrolment_ewma(w.ref("dim_students"))),
    "enrolment_regression": _on(lambda w: fields.enrolment_regression(w.ref("dim_students"))),
}

# --- documented views, risk, reports --------------------------------------------------

DOCUMENTED: dict[str, Query] = {
    "jahrgang_kpi_view": _on(
        lambda w: documented_views.jahrgang_kpi_view(w.ref("stg_students_with_credits"), w.ref("dim_modul"))
    ),
    "studienrichtung_kpi_view_v1": _on(
        lambda w: documented_views.studienrichtung_kpi_view_v1(
            w.ref("stg_students_with_credits"), w.ref("stg_students_clean"), w.ref("dim_modul")
        )
    ),
    "studiengang_kpi_view": _on(
        lambda w: documented_views.studiengang_kpi_view(w.ref("stg_students_with_credits"), w.ref("dim_modul"))
    ),
    "student_kpi_view_v1": _fact(documented_views.student_kpi_view_v1),
    "modul_kpi_view_v1": _on(lambda w: documented_views.modul_kpi_view_v1(w.ref("fact_kpi"), w.ref("dim_modul"))),
    "studienrichtung_kpi_view": _on(
        lambda w: documented_views.studienrichtung_kpi_view(w.ref("fact_kpi"), w.ref("dim_students"), w.ref("dim_modul"))
    ),
    "risk_flag": _on(lambda w: risk.risk_flag(w.ref("student_kpi"), w.ref("dim_students"))),
    "early_warning_metrics": _on(
        lambda w: risk.early_warning_metrics(
            w.ref("student_kpi"), w.ref("dim_students"), w.ref("study_progress_rows"), w.ref("stg_students_clean")
        )
    ),
    "dedupe_raw": _on(lambda w: checks.dedupe_raw(w.ref("students"))),
    "invalid_combo_report": _on(lambda w: checks.invalid_combo_report(w.ref("stg_students_with_credits"), w.ref("dim_modul"))),
    "anomaly_counts": _on(lambda w: checks.anomaly_counts(w.ref("students"), w.ref("stg_students_with_credits"), w.ref("dim_modul"))),
    "dependency_report": _on(lambda w: dependencies.dependency_report(w.ref("students"), checks.DEPENDENCIES)),
    "dependency_search": _on(lambda w: dependencies.dependency_search(w.ref("module"), list(checks.SEARCHED))),
    "profile_distinct": _on(lambda w: checks.profile_distinct(w.ref("students"))),
}

# --- data checks -------------------------------------------------------------------------

QUALITY: dict[str, Query] = {
    "dq_not_null": _on(
        lambda w: quality.dq_not_null(w.ref("stg_students_with_credits"), "exam_status").select(
            "attempt_id", "student_id", "module_number"
        )
    ),
    "dq_unique": _on(lambda w: quality.dq_unique(w.ref("dim_modul"), "module_id")),
    "dq_accepted_values": _on(
        lambda w: quality.dq_accepted_values(w.ref("stg_students_with_credits"), "exam_annotation", ("anerkannt", "krank"))
    ),
    "dq_relationships": _on(
        lambda w: quality.dq_relationships(w.ref("stg_students_clean"), "module_number", w.ref("dim_modul"), "module_id")
    ),
    "dq_between": _on(
        lambda w: quality.dq_between(w.ref("stg_students_with_credits"), "tries_count", 1, 20).select(
            "attempt_id", "tries_count"
        )
    ),
    "dq_single_credit_award": _on(lambda w: quality.dq_single_credit_award(w.ref("stg_students_with_credits"))),
    "dq_report": _on(lambda w: w.report()),
}

HABITS: dict[str, Query] = {
    "completed_days": _events(streaks.completed_days),
    "streaks": _events(streaks.streaks),
    "streak_milestone": _events(streaks.streak_milestone),
    "completion_rate": _events(streaks.completion_rate),
    "weekly_completion": _events(streaks.weekly_completion),
    "weekly_calendar": _events(streaks.weekly_calendar),
    "growth_percent": _events(streaks.growth_percent),
}


def _model(name: str) -> Query:
    return _on(lambda w: w.ref(name))


MODELS: dict[str, Query] = {name: _model(name) for name in (*LAYERS, *KPIS) if name not in INTERNAL}


# --- training text ---------------------------------------------------------------------------

#: The subpackage and the pipeline may be taken out; nothing else depends on them.
OPTIONAL = ("gradewell.llm", "corpus_pipeline")


def training_text() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and statements of the subpackage ``llm`` and of the pipeline, if they are there."""
    try:
        import corpus_pipeline
        from gradewell.llm.queries import QUERIES
        from gradewell.llm.statements import STATEMENTS
    except ImportError as missing:  # the other queries do without it, whatever it lacks
        if missing.name is None or not missing.name.startswith(OPTIONAL):
            warnings.warn(f"queries for training text are left out: {missing}", stacklevel=2)
        return {}, {}
    statements = dict(STATEMENTS)
    if corpus_pipeline.ORACLE_SQL is not None:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, statements


def queries() -> dict[str, Query]:
    """One entry per operator: (session, folder of the tables) to a DataFrame."""
    return {
        **MODELS, **SOURCES, **CLEANING, **DIMENSIONS, **ENRICHMENT, **PARTS, **DOCUMENTED, **QUALITY, **HABITS,
        **training_text()[0],
    }


def oracle_sql() -> dict[str, str]:
    """The equivalent DuckDB statement of every query."""
    return {**_oracle_sql(), **training_text()[1]}
