"""KPI corner cases, and the programme KPIs against the literal cross join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.operators import enrichment, quality, streaks
from gradewell.oracle.declared import CHECKS
from gradewell.plans import checks, fields, programme, risk
from gradewell.operators.summary import student_summary, thesis_failed_for_good


def literal_programme(small):
    """The programme row from the plain product: attempts, their catalogue rows, and every graduate beside each."""
    fact, students, modules = (small.ref(n) for n in ("fact_kpi", "dim_students", "dim_modul"))
    holders = programme.students_with_degree(fact).withColumnRenamed("student_id", "holder")
    short = students.filter(F.col("terms_taken_total_count") <= programme.STANDARD_TERMS).select(F.col("student_id").alias("holder"))
    in_time = holders.join(short.distinct(), "holder", "left_semi").withColumn("timely", F.lit(1))
    product = (
        fact.join(students.drop("field_of_study"), "student_id")
        .join(modules.select("module_id"), "module_id")
        .crossJoin(holders.join(in_time, "holder", "left"))
    )
    passed, grade, credits = F.col("passed_flag") == 1, F.col("grade_numeric").cast("decimal(3,1)"), F.col("credits_earned")
    thesis = F.col("module_id") == t.THESIS
    lost = F.col("inactivity_flag") | thesis_failed_for_good()

    def share(condition):
        return F.round(100 * F.countDistinct(F.when(condition, F.col("student_id"))) / F.countDistinct("student_id"), 2)

    return product.agg(
        F.countDistinct("student_id"), share(thesis & passed), share(lost),
        F.round(
            F.sum(F.when(passed, grade * credits)).cast("double")
            / F.sum(F.when(passed & grade.isNotNull(), credits)), 2,
        ),
        F.median("grade_numeric"), F.round(100 * F.count("timely") / F.count("holder"), 2),
    ).first()


def test_programme_equals_the_cross_join(small):
    row = small.ref("studiengang_kpi").first()
    found = (
        row.students_total_count, row.graduation_rate, row.dropout_rate, row.weighted_avg_program_grade,
        row.median_program_grade, row.master_on_track_percent,
    )
    assert found == pytest.approx(tuple(literal_programme(small)))


def test_programme_without_graduates(small):
    fact = small.ref("fact_kpi").filter("module_id <> 'I707'")
    row = programme.studiengang_kpi(
        student_summary(fact, small.ref("dim_modul")), small.ref("dim_students"), small.ref("study_progress_kpi")
    ).first()
    assert row.students_total_count == 0
    assert row.offtrack_rate is not None and row.ontrack_rate is not None
    missing = ("graduation_rate", "dropout_rate", "weighted_avg_program_grade", "median_program_grade", "avg_terms_taken", "master_on_track_percent")
    assert all(row[name] is None for name in missing)


def test_programme_with_a_single_joined_row(spark, small):
    fact = small.ref("fact_kpi").filter("module_id = 'I707' and grade_numeric < 4 and passed_flag = 1").limit(1)
    modules = small.ref("dim_modul").filter("module_id = 'I707'").limit(1)
    fact = spark.createDataFrame(fact.collect(), fact.schema)
    modules = spark.createDataFrame(modules.collect(), modules.schema)
    row = programme.studiengang_kpi(student_summary(fact, modules), small.ref("dim_students"), small.ref("study_progress_kpi")).first()
    assert row.students_total_count == 1 and row.master_on_track_percent is None


def test_cohort_rates_are_complete(small):
    sums = small.ref("cohort_kpi").agg(F.sum("enrollments")).first()[0]
    assert sums == small.ref("dim_students").count()
    assert small.ref("student_summary").count() <= sums


def test_summary_equals_plain_groups(small):
    """Every part of the summary against a plain grouping of the attempts."""
    fact, summary = small.ref("fact_kpi"), small.ref("student_summary")
    terms = summary.select("student_id", F.inline("terms"))
    plain = fact.groupBy("student_id", F.col("term_counter").alias("term")).agg(F.sum("credits_earned").alias("credits"))
    assert terms.exceptAll(plain).isEmpty() and plain.exceptAll(terms).isEmpty()
    weights = small.ref("dim_modul").groupBy("module_id").agg(F.count("*").alias("k"), F.sum("credits").alias("c"))
    grades = summary.select("student_id", F.inline("grades"))
    passed = F.when((F.col("passed_flag") == 1) & F.col("grade_numeric").isNotNull(), F.col("credits_earned") * F.col("k"))
    plain = fact.join(weights, "module_id").groupBy("student_id", F.col("grade_numeric").alias("grade")).agg(
        F.count("*").alias("n"), F.sum("credits_earned").alias("credits"), F.sum("k").alias("weight"),
        F.sum("c").alias("catalogue_credits"), F.sum(passed).alias("passed_weighted"),
    )
    assert grades.exceptAll(plain).isEmpty() and plain.exceptAll(grades).isEmpty()
    per_module = fact.groupBy("student_id", "module_id").agg(F.max("passed_flag").alias("p"), F.count("*").alias("n"), F.sum("credits_earned").alias("c"))
    plain = per_module.groupBy("student_id").agg(
        F.count("*").alias("modules"), F.sum("p").cast("bigint").alias("modules_passed"), F.count_if(F.col("n") > 1).alias("modules_repeated"), F.sum("c").alias("credits")
    )
    found = summary.select("student_id", "modules", F.col("modules_passed").cast("bigint"), "modules_repeated", "credits")
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


@pytest.mark.parametrize("name", ["cohort_kpi", "studiengang_kpi", "student_kpi"])
def test_kpis_of_students_read_the_summary_alone(spark, small, name):
    """No attempt is read, and the buckets of the summary are not moved."""
    from gradewell.plans.warehouse import MODELS

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small.ref(name)
        plan = MODELS[name](small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "/fact_kpi" not in plan and "student_summary" in plan
    above: list[tuple[int, str]] = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-*()0123456789"))
        above = [*(a for a in above if a[0] < depth), (depth, line)]
        if "student_summary" in line:
            assert not any("Exchange hashpartitioning(student_id" in text for _, text in above)
    if name == "student_kpi":
        assert "Exchange" not in plan


def test_progress_invariants(small):
    progress, student = small.ref("study_progress_kpi"), small.ref("student_kpi")
    last = progress.groupBy("student_id").agg(F.max("cumulative_ects").alias("last"), F.sum("credits_per_term").alias("sum"))
    assert last.filter("last <> sum").isEmpty()
    assert progress.filter("credit_change is null and term_counter > 1").join(
        progress.groupBy("student_id").agg(F.min("term_counter").alias("term_counter")), ["student_id", "term_counter"], "left_anti"
    ).isEmpty()
    assert student.filter("abs(pass_rate + fail_rate - 100) > 0.011").isEmpty()


def test_matching_keeps_every_row(small):
    clean = small.ref("stg_students_clean").withColumn("study_regulations_year", F.lit(11))
    assert enrichment.best_module_match(clean, small.ref("dim_modul")).count() == clean.count()


def test_hot_modules_with_a_large_catalogue(spark, small):
    """Lookups too large to broadcast, every module hot: the same rows as by Spark's own choice."""
    clean = small.ref("stg_students_clean").withColumn("study_regulations_year", F.lit(11).cast("bigint"))
    modules = small.ref("dim_modul")
    pairs = [
        (enrichment.best_module_match(clean, modules), enrichment.best_module_match(clean, modules, 0, 50)),
        (
            enrichment.credits_awarded_conceptual(clean, modules),
            enrichment.credits_awarded_conceptual(clean, modules, rows_per_task=50, lookup_rows=0),
        ),
    ]
    for expected, found in pairs:
        found = found.select(*expected.columns)
        assert "BroadcastHashJoin" in str(expected._jdf.queryExecution().executedPlan().toString())
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_credits_at_most_once(small):
    assert quality.dq_single_credit_award(small.ref("stg_students_with_credits")).isEmpty()
    enriched = small.ref("stg_students_with_credits")
    twice = enriched.unionAll(enriched)
    assert not quality.dq_single_credit_award(twice).isEmpty()


def test_conceptual_credits_once_per_module(small):
    awarded = enrichment.credits_awarded_conceptual(small.ref("stg_students_clean"), small.ref("dim_modul"))
    per_module = awarded.groupBy("student_id", "module_number").agg(F.count_if(F.col("credits_awarded") > 0).alias("n"))
    assert per_module.filter("n > 1").isEmpty() and not per_module.filter("n = 1").isEmpty()


def test_single_year_has_no_regression(spark):
    df = spark.createDataFrame([(71, 11, 5), (72, 11, 5), (72, 12, 7)], "field_of_study long, year_of_matriculation long, matriculations_count long")
    rows = {(r.field_of_study, r.year_of_matriculation): r for r in fields.with_regression(df).collect()}
    assert rows[71, 11].regression_slope is None and rows[71, 11].regression_trend_value is None
    assert rows[72, 12].regression_slope == 2.0 and rows[72, 12].regression_trend_value == 7.0


def test_ewma_and_growth(spark):
    df = spark.createDataFrame([(71, 11, 10), (71, 13, 20), (71, 14, 0), (71, 15, 30)], "field_of_study long, year_of_matriculation long, matriculations_count long")
    rows = fields.with_ewma(fields.with_growth(df)).orderBy("year_of_matriculation").collect()
    assert [r.ewma_enrollments for r in rows] == [10.0, 17.0, 8.0, 19.0]
    assert [r.growth_rate_vs_ewma_percent for r in rows] == [0.0, 17.65, -100.0, 57.89]
    assert [r.matriculations_growth_rate for r in rows] == [None, 100.0, -100.0, None]


def test_risk_levels(spark):
    kpi = spark.createDataFrame(
        [(1, 0, 100, 2.0, 0.0), (2, 2, 100, 2.0, 0.0), (3, 0, 100, 3.5, 0.0), (4, 0, 59, 2.0, 0.0), (5, 0, 60, 2.0, 0.0), (6, 0, 120, 3.0, 20.0), (7, 0, 120, None, 20.1), (8, 0, 120, None, 40.1), (9, 0, 120, 1.0, 0.0)],
        "student_id long, failed_attempts_count long, credits_total_count long, weighted_avg_grade double, fail_rate double",
    )
    dims = spark.createDataFrame([(i, 4, i == 9) for i in range(1, 10)], "student_id long, terms_taken_total_count long, inactivity_flag boolean")
    found = {r.student_id: r.risk_flag for r in risk.risk_flag(kpi, dims).collect()}
    twice = dims.unionByName(dims)  # a student of several fields
    assert sorted(r.student_id for r in risk.risk_flag(kpi, twice).collect()) == list(range(1, 10))
    assert found == {1: "GREEN", 2: "RED", 3: "RED", 4: "RED", 5: "ORANGE", 6: "ORANGE", 7: "ORANGE", 8: "RED", 9: "ORANGE"}


def test_declared_checks():
    kinds = {"not_null": 57, "unique": 4, "accepted": 20, "between": 8, "parents": 5}
    assert {k: sum(len(getattr(c, k)) for c in checks.DECLARED.values()) for k in kinds} == kinds
    assert sum(map(len, CHECKS.values())) == 94


def test_report_findings(spark):
    """Literal rows for the documented edge cases."""
    rows = [
        (1, 11, "WiSe", "bestanden", 1.0, "k1", 40, 9), (1, 11, "WiSe", "bestanden", 1.0, "k2", 30, 2),
        (2, 11, "WiSe", "nicht bestanden", 5.0, "k2", 0, 1), (2, 11, "SoSe", "bestanden", 2.0, None, 60, 1),
    ]
    enriched = spark.createDataFrame(
        rows, "student_id long, year long, semester_type string, exam_status string, grade double, module_key string, credits_earned long, term_counter long"
    )
    modules = spark.createDataFrame([("A", "k1", 5), ("A", "k2", None), ("B", "k3", 5), ("B", "k4", 6)], "module_id string, module_key string, credits long")
    found = {r.finding: r.n_rows for r in checks.invalid_combo_report(enriched, modules).collect()}
    assert found["passed_without_credits"] == 1 and found["unusually_long_study"] == 1
    assert found["unrealistic_credit_sum"] == 1 and found["module_with_differing_credits"] == 1
    assert found["passed_without_catalogue_entry"] == 1
    students = spark.createDataFrame([], t.STUDENTS)
    odd = {r.finding: r.n_rows for r in checks.anomaly_counts(students, enriched, modules).collect()}
    assert odd["catalogue_credits_missing"] == 2 and odd["catalogue_entry_missing"] == 1


def test_report_has_a_status(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 7), (1, None, 8), (None, "c", 9)], "k int, v string, p int").write.parquet(path)
    parent = spark.createDataFrame([(7,), (8,)], "id int")
    tables = {"t": spark.read.parquet(path), "parent": parent}
    declared = {"t": quality.Checks(
        not_null=("v", "p"), unique=("k",), accepted={"v": ("a", "c")}, between={"p": (0, 8)}, parents={"p": ("parent", "id")}
    )}
    report = quality.report(tables.__getitem__, declared)
    found = {(r.column_name, r.check_name): (r.violations, r.status) for r in report.collect()}
    assert found == {
        ("v", "not_null"): (1, "fail"), ("p", "not_null"): (0, "pass"), ("k", "unique"): (1, "fail"),
        ("v", "accepted_values"): (0, "pass"), ("p", "between"): (1, "fail"), ("p", "relationships"): (1, "fail"),
    }
    assert quality.summary(report).first() == (6, 2, 4)
    known = quality.report(tables.__getitem__, declared, lambda name: quality.counted(tables[name], declared[name]))
    assert {tuple(r) for r in known.collect()} == {tuple(r) for r in report.collect()}


def test_single_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c"), (9, "a")], "k int, v string")
    assert quality.dq_not_null(df, "v").count() == 1
    assert [tuple(r) for r in quality.dq_unique(df, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.dq_accepted_values(df, "v", ("a",)).collect()] == [("c", 1)]
    assert quality.dq_between(df, "k", 1, 8).count() == 1
    assert [tuple(r) for r in quality.dq_relationships(df, "k", df.filter("k = 9"), "k").collect()] == [(1, 2)]


def test_streaks(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-06"]
    rows = [(1, "run", d) for d in days] + [(2, "run", "2024-01-03")]
    events = spark.createDataFrame(rows, "user_id long, event_type string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    found = {r.user_id: (r.current_streak, r.longest_streak) for r in streaks.streaks(events).collect()}
    assert found == {1: (2, 3), 2: (0, 1)}
    rate = {r.user_id: (r.days_done, r.days_in_span) for r in streaks.completion_rate(events).collect()}
    assert rate == {1: (5, 6), 2: (1, 4)}
    weeks = {(r.user_id, str(r.week_start)): r.days_done for r in streaks.weekly_calendar(events.unionByName(events.filter("user_id = 2").withColumn("ts", F.col("ts") - F.expr("INTERVAL 21 DAY")))).collect()}
    assert weeks == {(1, "2024-01-01"): 5, (2, "2023-12-11"): 1, (2, "2023-12-18"): 0, (2, "2023-12-25"): 0, (2, "2024-01-01"): 1}
    reached = streaks.streak_milestone(events, (3,)).filter("reached").collect()
    assert [r.user_id for r in reached] == [1]
    assert {r.user_id: r.growth_percent for r in streaks.growth_percent(events, 4).collect()} == {1: 100.0, 2: 25.0}
