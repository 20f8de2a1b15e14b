"""One statement per query key."""

from __future__ import annotations

from gradewell.oracle.declared import CHECKS


def _values(values: tuple) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _violations(model: str, column: str, check: str, argument) -> str:
    if check == "not_null":
        return f"SELECT count(*) - count({column}) FROM {model}"
    if check == "unique":
        return f"SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    if check == "accepted_values":
        return f"SELECT count(*) FROM {model} WHERE {column} NOT IN ({_values(argument)})"
    if check == "between":
        return f"SELECT count(*) FROM {model} WHERE {column} < {argument[0]} OR {column} > {argument[1]}"
    parent, key = argument
    return f"SELECT count(*) FROM {model} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"


def _report(declared: dict[str, tuple]) -> str:
    """Violations of every declared check, one SELECT each."""
    parts = [
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS check_name, ({_violations(model, column, check, argument)}) AS violations"
        for model, checks in declared.items()
        for column, check, argument in checks
    ]
    return "SELECT *, CASE violations WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + "\nUNION ALL ".join(parts) + ")"


def _findings(source: str, conditions: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS finding, count(*) AS n_rows FROM {source} WHERE {condition}" for name, condition in conditions.items()
    )


def _rates(key: str, select_key: str) -> str:
    """Documented rates over the fan-out, students counted apart."""
    return f"""SELECT {select_key} count(DISTINCT module_id) AS gesamt_anzahl_module,
  round(1e2 * count(*) FILTER (WHERE passed) / count(*), 2) AS bestehensquote_prozent,
  round(1e2 * count(*) FILTER (WHERE NOT passed) / count(*), 2) AS durchfallquote_prozent,
  round(CAST(sum(g10 * credits) AS DOUBLE) / nullif(10 * sum(CASE WHEN passed THEN credits ELSE 0 END), 0), 2) AS durchschnittsnote_gewichtet,
  median(CAST(grade AS DOUBLE)) FILTER (WHERE passed) AS median_note, {key} AS gesamt_anzahl_studierende FROM decided"""


LAYER_NAMES = (
    "stg_students_clean", "dim_students", "dim_modul", "stg_students_with_credits", "dim_zeit",
    "dim_students_with_credits", "fact_kpi",
)
KPI_NAMES = (
    "active_students_kpi", "module_boxplot_kpi", "modul_kpi", "grade_development_kpi", "study_progress_kpi",
    "studienrichtung_mark_kpi", "student_kpi", "cohort_kpi", "studiengang_kpi", "studiengangsvergleich_kpi",
)
SAME_NAME = (
    "student_attributes", "term_progress", "student_module_rollup", "student_grades", "module_exam_delay", "module_acronym",
    "cohort_ontrack", "active_by_field_year", "avg_grade_by_field_year", "dropouts_by_field_year",
    "dropout_rate_by_field_year", "enrolment_growth", "enrolment_ewma", "enrolment_regression",
)
PROFILED = ("Note", "Modulnummer", "Jahr", "Semester", "Vermerk", "Studienrichtung")



def _dependency(table: str, determinant: tuple[str, ...], value: str) -> str:
    """Rows that a dependency leaves over in groups of equal determinants, the most frequent value kept."""
    left = ", ".join(f'"{c}"' for c in determinant)
    return f"""SELECT '{", ".join(determinant)} -> {value}' AS dependency, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups,
  count(*) FILTER (WHERE n_values > 1) AS broken_groups, CAST(sum(n - kept) AS BIGINT) AS rows_to_delete, {len(determinant)} AS n_determinants
FROM (SELECT sum(c) AS n, max(c) AS kept, count(*) AS n_values
  FROM (SELECT {left}, "{value}" AS v, count(*) AS c FROM {table} GROUP BY {left}, v) GROUP BY {left})"""


SEARCHED = ("Modulnummer", "Modul", "Acronym", "Art", "Credits", "Semester", "AbJahr", "Studienrichtung")
_SINGLE = {(a, v): _dependency("raw_module", (a,), v) for a in SEARCHED for v in SEARCHED if a != v}
_PAIRS = {
    (a, b, v): _dependency("raw_module", (a, b), v)
    for i, a in enumerate(SEARCHED) for b in SEARCHED[i + 1 :] for v in SEARCHED if v not in (a, b)
}

STATEMENTS: dict[str, str] = {name: f"SELECT * FROM {name}" for name in (*LAYER_NAMES, *KPI_NAMES, *SAME_NAME)}
STATEMENTS |= {
    # sources and sinks
    "scan_students": "SELECT * FROM raw_students",
    "seed_module": "SELECT * FROM raw_module",
    "scan_student_ml": "SELECT * FROM raw_student_ml",
    "lookup_field": """SELECT student_id, field_of_study, CASE field_of_study WHEN 71 THEN 'Informations- und Kommunikationstechnologien'
        WHEN 72 THEN 'Wirtschaftsinformatik' WHEN 73 THEN 'Medieninformatik' WHEN 74 THEN 'Data Science' END AS field_name FROM dim_students""",
    "ref": "\nUNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS n_rows FROM {n}" for n in (*LAYER_NAMES, *KPI_NAMES))
    + "\nUNION ALL SELECT 'module_mark_kpi', count(grade_numeric) FROM fact_kpi"
    + "\nUNION ALL SELECT 'module_status_kpi', count(*) FROM fact_kpi"
    + "\nUNION ALL SELECT 'student_kpi_ml', count(*) FROM student_kpi k LEFT JOIN raw_student_ml ml ON ml.student_id = k.student_id",
    "write_table": "SELECT * FROM active_students_kpi",
    "create_view": "SELECT exam_status, count(*) AS n_rows FROM fact_kpi GROUP BY exam_status",
    "create_or_replace_table": "SELECT * FROM study_progress_kpi",
    "create_enum": "\nUNION ALL ".join(
        f"SELECT '{column}' AS enum, '{label}' AS label, {position} AS position, count(*) AS n_rows FROM stg_students_clean WHERE {column} = '{label}'"
        for column, labels in (
            ("exam_status", ("bestanden", "nicht bestanden", "abgemeldet")),
            ("semester_type", ("WiSe", "SoSe")),
            ("exam_annotation", ("abgemeldet", "anerkannt", "krank", "nicht zugelassen", "unentschuldigt gefehlt")),
        )
        for position, label in enumerate(labels)
    ),
    # cleaning
    "filter_main_grades": "SELECT * FROM main_grades",
    "map_module_number": "SELECT attempt_id, module_number FROM numbered",
    "clean_grade": "SELECT attempt_id, grade FROM graded",
    "grade_numeric": "SELECT attempt_id, grade_numeric FROM graded",
    "derive_exam_status": "SELECT attempt_id, exam_status FROM judged",
    "normalise_semester": "SELECT attempt_id, semester_type FROM judged",
    "clean_year": "SELECT attempt_id, year FROM judged",
    "clean_remark": """SELECT attempt_id, CASE WHEN exam_annotation IN ('abgemeldet', 'anerkannt', 'krank', 'nicht zugelassen', 'unentschuldigt gefehlt')
        THEN exam_annotation END AS exam_annotation FROM judged""",
    "drop_undated": "SELECT attempt_id, year, semester_type FROM dated",
    "term_counter": "SELECT attempt_id, term_counter FROM dated JOIN student_terms USING (student_id, term)",
    "matriculation_year": "SELECT student_id, year_of_matriculation FROM student_starts",
    "matriculation_semester": "SELECT student_id, semester_of_matriculation FROM student_starts",
    "primary_field": "SELECT student_id, primary_field_of_study FROM student_starts LEFT JOIN field_votes USING (student_id)",
    "normalise_field": "SELECT attempt_id, field_of_study FROM stg_students_clean",
    "cast_enums": "SELECT attempt_id, exam_status, semester_type, exam_annotation FROM dated",
    # dimensions
    "degree_completion": "SELECT student_id, i707_pass_count FROM student_facts",
    "term_totals": "SELECT student_id, terms_taken_total_count FROM student_facts",
    "start_semester_index": """SELECT student_id, year_of_matriculation * 2 + CASE semester_of_matriculation WHEN 'SoSe' THEN 1 ELSE 2 END AS start_semester_index
        FROM student_attributes""",
    "current_semester_index": "SELECT current_semester_index FROM latest_term",
    "graduation_flag": "SELECT student_id, i707_pass_count >= 1 AS graduation_flag FROM student_facts",
    "inactivity_flag": "SELECT student_id, inactivity_flag FROM dim_students",
    "module_key": "SELECT module_id, graduation_year, graduation_semester, field_of_study, module_key FROM dim_modul",
    # enrichment
    "running_pass_count": "SELECT attempt_id, student_id, module_number, term_counter, passed_so_far FROM tracked",
    "best_module_match": "SELECT attempt_id, module_key, module_title, module_acronym, credits, recommended_semester FROM enriched",
    "match_quality": "SELECT attempt_id, match_quality FROM enriched",
    "credits_earned": "SELECT attempt_id, credits_earned FROM stg_students_with_credits",
    "exam_plan_dif": "SELECT attempt_id, exam_plan_dif FROM stg_students_with_credits",
    "module_not_in_plan": "SELECT attempt_id, module_not_in_plan FROM stg_students_with_credits",
    "core_module_sanity": "SELECT attempt_id, sanity_check FROM stg_students_with_credits",
    "should_count_try": "SELECT attempt_id, should_count_try FROM counted",
    "tries_count": "SELECT attempt_id, tries_count FROM stg_students_with_credits",
    "withdrawal_count": "SELECT attempt_id, withdrawal_count FROM stg_students_with_credits",
    "term_date": "SELECT attempt_id, term_date FROM stg_students_with_credits",
    "credits_awarded_conceptual": """SELECT student_id, module_number, module_title, semester_type, year, exam_status, exam_annotation, grade_numeric,
        credits AS credits_catalog, CASE WHEN eligible AND seen = 1 THEN coalesce(credits, 0) ELSE 0 END AS credits_awarded, field_of_study, attempt_id
      FROM (SELECT *, sum(CASE WHEN eligible THEN 1 ELSE 0 END) OVER (PARTITION BY student_id, module_number
              ORDER BY year, semester_type, attempt_id, module_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
            FROM (SELECT c.*, m.module_title, m.credits, m.module_key,
                    coalesce(c.exam_status = 'bestanden', FALSE) OR coalesce(c.exam_annotation = 'anerkannt', FALSE) AS eligible
                  FROM stg_students_clean c LEFT JOIN dim_modul m ON m.module_id = c.module_number))""",
    # KPI tables and their parts
    "module_mark_kpi": "SELECT student_id, module_id, grade_numeric FROM fact_kpi WHERE grade_numeric IS NOT NULL",
    "module_status_kpi": "SELECT student_id, module_id, exam_status FROM fact_kpi",
    "student_kpi_ml": "SELECT k.*, ml.* EXCLUDE (student_id) FROM student_kpi k LEFT JOIN raw_student_ml ml ON ml.student_id = k.student_id",
    "module_students_total": "SELECT module_id, students_total FROM module_students",
    "module_students_passed": "SELECT module_id, students_passed FROM module_students WHERE students_passed > 0",
    "module_students_failed": "SELECT module_id, students_failed FROM module_students WHERE students_failed > 0",
    "module_finally_failed": "SELECT module_id, students_finally_failed FROM module_students WHERE students_finally_failed > 0",
    "module_first_try_passed": "SELECT module_id, students_first_try_passed FROM module_students WHERE students_first_try_passed > 0",
    "module_bottleneck": "SELECT module_id, bottleneck_value FROM module_students",
    "students_clean_semester": """SELECT time_id, student_id FROM fact_kpi GROUP BY ALL
        HAVING bool_and(coalesce(exam_status = 'bestanden', TRUE) AND tries_count = 1)""",
    "program_offtrack": "SELECT CAST(sum(ontrack_flag) AS BIGINT) AS total_offtrack_semesters, count(*) AS total_semesters FROM study_progress_kpi",
    "program_avg_terms": "SELECT avg(terms_taken_total_count) AS avg_terms_taken FROM dim_students WHERE graduation_flag",
    "students_with_degree": "SELECT student_id FROM degree_holders",
    "students_in_standard_period": "SELECT student_id FROM standard_period",
    "enrolments_by_field_year": "SELECT * FROM enrolments",
    "study_progress": "SELECT * FROM study_progress",
    # documented views
    "jahrgang_kpi_view": _rates("count(DISTINCT student_id)", "year,") + " GROUP BY year",
    "studiengang_kpi_view": _rates("count(DISTINCT student_id)", ""),
    "studienrichtung_kpi_view_v1": _rates(
        "(SELECT count(DISTINCT c.student_id) FROM stg_students_clean c WHERE c.field_of_study = catalogue_field)",
        "catalogue_field AS field_of_study,",
    ) + " GROUP BY catalogue_field",
    "student_kpi_view_v1": """SELECT student_id, count(DISTINCT module_id) AS module_gesamt, round(avg(passed_flag) * 100, 2) AS bestehensrate_je_student,
        round(avg(1 - passed_flag) * 100, 2) AS nichtbestehensrate_je_student, round(1e2 * count(*) FILTER (WHERE tries_count > 1) / count(*), 2) AS wiederholungsrate_je_student
        FROM fact_kpi GROUP BY student_id""",
    "modul_kpi_view_v1": """SELECT f.module_id, m.module_title, round(avg(passed_flag) * 100, 2) AS bestehensrate, round(avg(1 - passed_flag) * 100, 2) AS nichtbestehensrate,
        round(1e2 * nullif(count(*) FILTER (WHERE tries_count = 1 AND passed_flag = 1), 0) / count(*), 2) AS first_try_rate,
        round(1e2 * nullif(count(*) FILTER (WHERE tries_count > 1), 0) / count(*), 2) AS wiederholungsrate, count(DISTINCT f.student_id) AS total_students
        FROM fact_kpi f JOIN dim_modul m ON m.module_id = f.module_id GROUP BY ALL""",
    "studienrichtung_kpi_view": """SELECT s.field_of_study, round(avg(passed_flag) * 100, 2) AS bestehensquote, round((1 - avg(passed_flag)) * 100, 2) AS durchfallquote,
        CAST(sum(passed_flag) AS BIGINT) AS bestandene_module, count(DISTINCT f.module_id) AS gesamtmodule, round(avg(CAST(graduation_flag AS INT)) * 100, 2) AS abschlussquote
        FROM fact_kpi f JOIN dim_students s ON s.student_id = f.student_id JOIN dim_modul m ON m.module_id = f.module_id GROUP BY s.field_of_study""",
    "risk_flag": """SELECT student_id, CASE
        WHEN failed_attempts_count >= 2 OR weighted_avg_grade >= 3.5 OR credits_total_count < terms_taken_total_count * 30 - 60 OR fail_rate > 40 THEN 'RED'
        WHEN fail_rate > 20 OR weighted_avg_grade >= 3 OR credits_total_count < terms_taken_total_count * 30 - 30 OR inactivity_flag THEN 'ORANGE'
        ELSE 'GREEN' END AS risk_flag FROM student_kpi JOIN (SELECT student_id, max(terms_taken_total_count) AS terms_taken_total_count,
          bool_or(inactivity_flag) AS inactivity_flag FROM dim_students GROUP BY student_id) USING (student_id)""",
    "early_warning_metrics": """SELECT k.student_id, 30 * f.terms_taken_total_count - k.credits_total_count AS ects_backlog, k.modules_failed_count AS repeated_modules,
        p.grade_change AS grade_trend, (SELECT current_semester_index FROM latest_term) - t.last_term AS inactive_terms
      FROM student_kpi k JOIN student_facts f USING (student_id) JOIN (SELECT student_id, max(term) AS last_term FROM dated GROUP BY student_id) t USING (student_id)
      LEFT JOIN (SELECT student_id, grade_change FROM study_progress QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY term_counter DESC) = 1) p USING (student_id)""",
    "dedupe_raw": """SELECT "studentID", "Modul", "Note", "Modulnummer", "Jahr", "Semester", "Vermerk", "Studienrichtung", min(attempt_id) AS attempt_id FROM raw_students GROUP BY ALL""",
    "dependency_report": "SELECT * EXCLUDE (n_determinants), rows_to_delete / n_rows AS violation FROM (\n"
    + "\nUNION ALL ".join(
        _dependency("raw_students", *d)
        for d in (
            (("Modulnummer",), "Modul"), (("Modul",), "Modulnummer"), (("studentID",), "Studienrichtung"),
            (("studentID", "Modulnummer", "Jahr", "Semester"), "Note"),
        )
    )
    + ")",
    "dependency_search": "SELECT * EXCLUDE (parts, holding) FROM (SELECT *, list(dependency) OVER () AS holding FROM (\n"
    + "\nUNION ALL ".join(
        [f"SELECT *, CAST([] AS VARCHAR[]) AS parts FROM ({q})" for q in _SINGLE.values()]
        + [f"SELECT *, ['{a} -> {v}', '{b} -> {v}'] AS parts FROM ({q})" for (a, b, v), q in _PAIRS.items()]
    )
    + ") WHERE rows_to_delete = 0) WHERE NOT list_has_any(parts, holding)",
    "fact_kpi_incremental": "SELECT * FROM fact_kpi",
    "invalid_combo_report": _findings(
        "stg_students_with_credits",
        {
            "passed_without_catalogue_entry": "exam_status = 'bestanden' AND module_key IS NULL",
            "passed_with_failing_grade": "exam_status = 'bestanden' AND grade > 4",
            "failed_with_passing_grade": "exam_status = 'nicht bestanden' AND grade <= 4",
            "withdrawn_with_grade": "exam_status = 'abgemeldet' AND grade IS NOT NULL",
            "no_status": "exam_status IS NULL",
            "no_status_with_grade": "exam_status IS NULL AND grade IS NOT NULL",
            "passed_without_credits": "exam_status = 'bestanden' AND module_key IN (SELECT module_key FROM dim_modul WHERE credits IS NULL)",
            "unusually_long_study": "term_counter > 8",
        },
    )
    + """
UNION ALL SELECT 'unrealistic_credit_sum', count(*) FROM (SELECT 1 FROM stg_students_with_credits GROUP BY student_id, year, semester_type HAVING sum(credits_earned) > 60)
UNION ALL SELECT 'module_with_differing_credits', count(*) FROM (SELECT 1 FROM dim_modul GROUP BY module_id HAVING count(DISTINCT credits) > 1)""",
    "anomaly_counts": _findings(
        "raw_students",
        {
            "year_missing": '"Jahr" IS NULL',
            "year_corrected": '"Jahr" = 29',
            "year_out_of_range": '"Jahr" <> 29 AND "Jahr" NOT BETWEEN 11 AND 25',
            "semester_missing": '"Semester" IS NULL',
            "semester_respelled": "lower(\"Semester\") IN ('wise', 'sose') AND \"Semester\" NOT IN ('WiSe', 'SoSe')",
            "semester_unknown": "lower(\"Semester\") NOT IN ('wise', 'sose')",
        },
    ) + "\nUNION ALL " + _findings(
        "stg_students_with_credits",
        {"catalogue_entry_missing": "module_key IS NULL", "catalogue_credits_missing": "module_key IN (SELECT module_key FROM dim_modul WHERE credits IS NULL)"},
    ),
    "profile_distinct": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(\"{c}\" AS VARCHAR) AS value, count(*) AS n_rows FROM raw_students GROUP BY \"{c}\"" for c in PROFILED
    ),
    # data checks
    "dq_not_null": "SELECT attempt_id, student_id, module_number FROM stg_students_with_credits WHERE exam_status IS NULL",
    "dq_unique": "SELECT module_id, count(*) AS n_rows FROM dim_modul GROUP BY module_id HAVING count(*) > 1",
    "dq_accepted_values": "SELECT exam_annotation, count(*) AS n_rows FROM stg_students_with_credits WHERE exam_annotation NOT IN ('anerkannt', 'krank') GROUP BY exam_annotation",
    "dq_relationships": "SELECT module_number, count(*) AS n_rows FROM stg_students_clean c WHERE module_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_modul p WHERE p.module_id = c.module_number) GROUP BY module_number",
    "dq_between": "SELECT attempt_id, tries_count FROM stg_students_with_credits WHERE tries_count < 1 OR tries_count > 20",
    "dq_single_credit_award": "SELECT student_id, module_number, count(*) AS awards FROM stg_students_with_credits WHERE credits_earned > 0 GROUP BY ALL HAVING count(*) > 1",
    "dq_report": _report(CHECKS),
    # habits
    "completed_days": "SELECT * FROM habit_days",
    "streaks": "SELECT * FROM habit_streaks",
    "streak_milestone": """SELECT user_id, event_type, longest_streak, milestone_days, longest_streak >= milestone_days AS reached
        FROM habit_streaks, (VALUES (7), (66)) v(milestone_days)""",
    "completion_rate": """SELECT user_id, event_type, count(*) AS days_done, (SELECT max(day) FROM habit_days) - min(day) + 1 AS days_in_span,
        CAST(count(*) AS DOUBLE) / ((SELECT max(day) FROM habit_days) - min(day) + 1) AS completion_rate FROM habit_days GROUP BY ALL""",
    "weekly_completion": """SELECT user_id, event_type, CAST(date_trunc('week', day) AS DATE) AS week_start, count(*) AS days_done, CAST(count(*) AS DOUBLE) / 7 AS weekly_rate
        FROM habit_days GROUP BY ALL""",
    "weekly_calendar": """SELECT s.user_id, s.event_type, CAST(w AS DATE) AS week_start, count(day) AS days_done, CAST(count(day) AS DOUBLE) / 7 AS weekly_rate
        FROM (SELECT user_id, event_type, unnest(weeks) AS w
              FROM (SELECT user_id, event_type, generate_series(date_trunc('week', min(day)), date_trunc('week', (SELECT max(day) FROM habit_days)), INTERVAL 7 DAY) AS weeks
                    FROM habit_days GROUP BY user_id, event_type)) s
        LEFT JOIN habit_days d ON d.user_id = s.user_id AND d.event_type = s.event_type AND date_trunc('week', d.day) = w
        GROUP BY s.user_id, s.event_type, w""",
    "growth_percent": """SELECT user_id, event_type, count(*) AS days_done, least(1e2, 1e2 * count(*) / 66) AS growth_percent FROM habit_days GROUP BY ALL""",
}
