"""KPI tables in SQL, in fan-out form where the definition fans out.

Grades are summed as whole tenths (``g10``), so that both engines divide the
same integers; percentages start from ``1e2``, which is a double where ``100.0``
would be a decimal.
"""

TABLES = {
    "active_students_kpi": """
SELECT year, semester_type, field_of_study, count(*) AS students_active_count
FROM (SELECT DISTINCT student_id, year, semester_type FROM stg_students_with_credits WHERE exam_status IN ('bestanden', 'nicht bestanden'))
JOIN dim_students USING (student_id) GROUP BY ALL
""",
    "module_boxplot_kpi": """
SELECT module_id, quantile_cont(grade_numeric, 0.25) AS first_quartile_grade, quantile_cont(grade_numeric, 0.75) AS third_quartile_grade,
  quantile_cont(grade_numeric, 0.5) AS median_grade, round(sum(g10) / (10 * count(g10)), 2) AS mean_grade
FROM fact10 GROUP BY module_id
""",
    "grade_development_kpi": """
SELECT year, semester_type,
  round(CAST(sum(g10 * credits_earned) FILTER (WHERE graded_pass) AS DOUBLE) / nullif(10 * sum(credits_earned) FILTER (WHERE graded_pass), 0), 2) AS average_grade_this_semester
FROM fact10 JOIN dim_zeit USING (time_id) GROUP BY ALL
""",
    "studienrichtung_mark_kpi": """
SELECT round(avg(a), 2) AS students_with_thesis_avg_final_grade, round(sum(t) / (10 * count(*)), 2) AS students_with_thesis_avg_master_thesis_grade
FROM (SELECT student_id, sum(g10) / (10 * count(g10)) AS a, min(g10) FILTER (WHERE module_id = 'I707') AS t FROM fact10 GROUP BY student_id)
WHERE t IS NOT NULL
""",
    "term_progress": """
SELECT student_id, term_counter, CAST(sum(credits_earned) AS BIGINT) AS credits_per_term, count(DISTINCT module_id) AS modules_per_term,
  round(sum(g10) / nullif(10 * count(g10), 0), 2) AS avg_grade_per_term, CASE WHEN sum(credits_earned) BETWEEN 25 AND 35 THEN 1 ELSE 0 END AS ontrack_flag
FROM fact10 GROUP BY ALL
""",
    "study_progress": """
SELECT student_id, term_counter, credits_per_term, modules_per_term, avg_grade_per_term,
  CAST(sum(credits_per_term) OVER (PARTITION BY student_id ORDER BY term_counter ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_ects,
  round(avg_grade_per_term - lag(avg_grade_per_term) OVER (PARTITION BY student_id ORDER BY term_counter), 2) AS grade_change,
  credits_per_term - lag(credits_per_term) OVER (PARTITION BY student_id ORDER BY term_counter) AS credit_change, ontrack_flag
FROM term_progress
""",
    "study_progress_kpi": """
SELECT p.*, d.inactivity_flag FROM study_progress p JOIN dim_students d USING (student_id)
""",
    "student_module_rollup": """
SELECT student_id, module_id, max(passed_flag) AS module_passed, CAST(sum(1 - passed_flag) AS BIGINT) AS failed_attempts, count(*) AS attempts,
  CAST(sum(credits_earned) AS BIGINT) AS credits_count_temp
FROM fact_kpi GROUP BY ALL
""",
    "student_grades": """
SELECT student_id, round(CAST(sum(g10 * credits_earned) AS DOUBLE) / nullif(10 * sum(credits_earned), 0), 2) AS weighted_avg_grade, median(grade_numeric) AS median_grade
FROM fact10 WHERE g10 IS NOT NULL GROUP BY student_id
""",
    "student_kpi": """
SELECT student_id, count(*) AS modules_count, CAST(sum(module_passed) AS BIGINT) AS modules_passed_count, CAST(sum(failed_attempts) AS BIGINT) AS failed_attempts_count,
  count(*) FILTER (WHERE attempts > 1) AS modules_failed_count, CAST(sum(credits_count_temp) AS BIGINT) AS credits_total_count,
  any_value(weighted_avg_grade) AS weighted_avg_grade, any_value(median_grade) AS median_grade,
  round(1e2 * sum(module_passed) / count(*), 2) AS pass_rate, round(100 - 1e2 * sum(module_passed) / count(*), 2) AS fail_rate,
  round(1e2 * count(*) FILTER (WHERE attempts > 1) / count(*), 2) AS repetition_rate
FROM student_module_rollup LEFT JOIN student_grades USING (student_id) GROUP BY student_id
""",
    "module_students": """
SELECT module_id, count(DISTINCT student_id) AS students_total,
  count(DISTINCT student_id) FILTER (WHERE exam_status = 'bestanden') AS students_passed,
  count(DISTINCT student_id) FILTER (WHERE exam_status = 'nicht bestanden') AS students_failed,
  count(DISTINCT student_id) FILTER (WHERE exam_status = 'nicht bestanden' AND tries_count = 3) AS students_finally_failed,
  count(DISTINCT student_id) FILTER (WHERE exam_status = 'bestanden' AND tries_count = 1) AS students_first_try_passed,
  CAST(count(*) - count(*) FILTER (WHERE tries_count = 1 AND passed_flag = 1) AS DOUBLE) / count(*) AS bottleneck_value
FROM fact_kpi GROUP BY module_id
""",
    "module_exam_delay": """
SELECT module_number, avg(exam_plan_dif) AS avg_exam_plan_diff FROM stg_students_with_credits GROUP BY module_number
""",
    "module_acronym": """
SELECT module_id, min(module_acronym) AS module_acronym FROM dim_modul GROUP BY module_id
""",
    "modul_kpi": """
SELECT module_id, module_acronym, students_finally_failed AS students_finally_failed_count, students_first_try_passed AS students_passed_first_try_count,
  round(CAST(students_failed AS DOUBLE) / (greatest(students_failed, 1) + greatest(students_passed, 1)) * 100, 2) AS students_failed_percent,
  round(CAST(students_finally_failed AS DOUBLE) / students_total * 100, 2) AS students_final_fail_percent,
  round(bottleneck_value, 2) AS bottleneck_value, round(avg_exam_plan_diff, 2) AS avg_exam_plan_diff
FROM module_students JOIN module_exam_delay ON module_number = module_id JOIN module_acronym USING (module_id)
""",
    "cohort_ontrack": """
SELECT year_of_matriculation, count(*) FILTER (WHERE credits BETWEEN 25 AND 35) AS ontrack_terms, count(*) AS total_terms
FROM (SELECT year_of_matriculation, student_id, term_counter, sum(credits_earned) AS credits FROM fact_kpi JOIN dim_students USING (student_id) GROUP BY ALL)
GROUP BY year_of_matriculation
""",
    "cohort_failures": """
SELECT year_of_matriculation, round(avg(failures), 2) AS avg_failed_attempts FROM
  (SELECT student_id, sum(1 - passed_flag) AS failures FROM fact_kpi GROUP BY student_id)
  JOIN (SELECT DISTINCT student_id, year_of_matriculation FROM dim_students) USING (student_id) GROUP BY year_of_matriculation
""",
    "cohort_kpi": """
SELECT s.year_of_matriculation AS intake_year, count(DISTINCT s.student_id) AS enrollments,
  round(1e2 * count(DISTINCT s.student_id) FILTER (WHERE m.module_id = 'I707' AND f.passed_flag = 1) / count(DISTINCT s.student_id), 2) AS graduation_rate,
  round(1e2 * count(DISTINCT s.student_id) FILTER (WHERE f.thesis_lost OR s.inactivity_flag) / count(DISTINCT s.student_id), 2) AS dropout_rate,
  round(CAST(sum(f.g10 * m.credits) AS DOUBLE) / nullif(10 * sum(m.credits) FILTER (WHERE f.g10 IS NOT NULL), 0), 2) AS weighted_avg_grade,
  median(f.grade_numeric) AS median_grade, any_value(x.avg_failed_attempts) AS avg_failed_attempts,
  any_value(round(1e2 * o.ontrack_terms / o.total_terms, 2)) AS ontrack_rate
FROM dim_students s LEFT JOIN fact10 f ON f.student_id = s.student_id LEFT JOIN dim_modul m ON m.module_id = f.module_id
LEFT JOIN cohort_ontrack o ON o.year_of_matriculation = s.year_of_matriculation LEFT JOIN cohort_failures x ON x.year_of_matriculation = s.year_of_matriculation
GROUP BY s.year_of_matriculation
""",
    "degree_holders": """
SELECT DISTINCT student_id FROM fact_kpi WHERE module_id = 'I707' AND grade_numeric IS NOT NULL AND grade_numeric <> 5
""",
    "standard_period": """
SELECT DISTINCT student_id FROM dim_students WHERE terms_taken_total_count <= 4 AND student_id IN (SELECT student_id FROM degree_holders)
""",
    "studiengang_kpi": """
SELECT 'entire_program' AS study_program_label, count(DISTINCT f.student_id) AS students_total_count,
  round(1e2 * count(DISTINCT f.student_id) FILTER (WHERE m.module_id = 'I707' AND f.passed_flag = 1) / count(DISTINCT f.student_id), 2) AS graduation_rate,
  round(1e2 * count(DISTINCT f.student_id) FILTER (WHERE f.thesis_lost OR s.inactivity_flag) / count(DISTINCT f.student_id), 2) AS dropout_rate,
  round(CAST(sum(f.g10 * f.credits_earned) FILTER (WHERE f.graded_pass) AS DOUBLE) / nullif(10 * sum(f.credits_earned) FILTER (WHERE f.graded_pass), 0), 2) AS weighted_avg_program_grade,
  median(f.grade_numeric) AS median_program_grade,
  (SELECT round(1e2 * sum(ontrack_flag) / count(*), 2) FROM study_progress_kpi) AS offtrack_rate,
  (SELECT round(100 - 1e2 * sum(ontrack_flag) / count(*), 2) FROM study_progress_kpi) AS ontrack_rate,
  (SELECT avg(terms_taken_total_count) FROM dim_students WHERE graduation_flag) AS avg_terms_taken,
  (SELECT round((SELECT count(*) FROM standard_period) / count(*) * 100, 2) FROM degree_holders) AS master_on_track_percent
FROM fact10 f JOIN dim_students s ON s.student_id = f.student_id JOIN dim_modul m ON m.module_id = f.module_id
""",
    "enrolments": """
SELECT field_of_study, year_of_matriculation, count(DISTINCT student_id) AS matriculations_count FROM dim_students GROUP BY ALL
""",
    "attempts_by_field": """
SELECT s.field_of_study, z.year, f.*, s.inactivity_flag FROM fact10 f JOIN dim_zeit z ON z.time_id = f.time_id JOIN dim_students s ON s.student_id = f.student_id
""",
    "active_by_field_year": """
SELECT field_of_study, year, count(DISTINCT student_id) AS students_active_count FROM attempts_by_field WHERE exam_status IN ('bestanden', 'nicht bestanden') GROUP BY ALL
""",
    "avg_grade_by_field_year": """
SELECT field_of_study, year,
  round(CAST(sum(g10 * credits_earned) FILTER (WHERE graded_pass) AS DOUBLE) / nullif(10 * sum(credits_earned) FILTER (WHERE graded_pass), 0), 2) AS weighted_avg_grade_per_year
FROM attempts_by_field GROUP BY ALL
""",
    "dropouts_by_field_year": """
SELECT DISTINCT field_of_study, year, student_id FROM attempts_by_field WHERE thesis_lost OR inactivity_flag
""",
    "dropout_rate_by_field_year": """
SELECT field_of_study, year, round(CAST(count(student_id) AS DOUBLE) / nullif(any_value(students_active_count), 0), 4) AS dropout_rate
FROM dropouts_by_field_year LEFT JOIN active_by_field_year USING (field_of_study, year) GROUP BY ALL
""",
    "enrolment_lags": """
SELECT *, lag(matriculations_count) OVER years AS one, lag(matriculations_count, 2) OVER years AS two FROM enrolments
WINDOW years AS (PARTITION BY field_of_study ORDER BY year_of_matriculation)
""",
    "enrolment_growth": """
SELECT field_of_study, year_of_matriculation, matriculations_count, one AS matriculations_prev_year_count,
  round(CAST(matriculations_count - one AS DOUBLE) / nullif(one, 0) * 100, 2) AS matriculations_growth_rate FROM enrolment_lags
""",
    "enrolment_ewma": """
SELECT field_of_study, year_of_matriculation, matriculations_count, round(e10 / 10, 2) AS ewma_enrollments,
  round(CAST(10 * matriculations_count - e10 AS DOUBLE) / nullif(e10, 0) * 100, 2) AS growth_rate_vs_ewma_percent
FROM (SELECT *, 5 * matriculations_count + 3 * coalesce(one, matriculations_count) + 2 * coalesce(two, matriculations_count) AS e10 FROM enrolment_lags)
""",
    "enrolment_regression": """
SELECT field_of_study, year_of_matriculation, matriculations_count, round(slope, 3) AS regression_slope, round(icept, 3) AS regression_intercept,
  round(icept + slope * year_of_matriculation, 3) AS regression_trend_value
FROM enrolments JOIN (
  SELECT field_of_study, CASE WHEN count(*) > 1 THEN regr_slope(matriculations_count, year_of_matriculation) END AS slope,
    CASE WHEN count(*) > 1 THEN regr_intercept(matriculations_count, year_of_matriculation) END AS icept
  FROM enrolments GROUP BY field_of_study) USING (field_of_study)
""",
    "studiengangsvergleich_kpi": """
SELECT g.*, a.students_active_count, w.weighted_avg_grade_per_year, d.dropout_rate, e.ewma_enrollments, e.growth_rate_vs_ewma_percent,
  r.regression_slope, r.regression_intercept, r.regression_trend_value
FROM enrolment_growth g JOIN enrolment_ewma e USING (field_of_study, year_of_matriculation) JOIN enrolment_regression r USING (field_of_study, year_of_matriculation)
LEFT JOIN active_by_field_year a ON a.field_of_study = g.field_of_study AND a.year = g.year_of_matriculation
LEFT JOIN avg_grade_by_field_year w ON w.field_of_study = g.field_of_study AND w.year = g.year_of_matriculation
LEFT JOIN dropout_rate_by_field_year d ON d.field_of_study = g.field_of_study AND d.year = g.year_of_matriculation
""",
    "decided": """
SELECT s.*, m.module_id, m.credits, m.field_of_study AS catalogue_field, s.exam_status = 'bestanden' AS passed, CAST(s.grade * 10 AS BIGINT) AS g10
FROM stg_students_with_credits s JOIN dim_modul m ON m.module_id = s.module_number WHERE s.exam_status <> 'abgemeldet'
""",
    "habit_days": """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
""",
    "habit_runs": """
SELECT user_id, event_type, max(day) AS last_day, count(*) AS length
FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id, event_type ORDER BY day ROWS UNBOUNDED PRECEDING) AS run FROM
  (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY user_id, event_type ORDER BY day) = 1 THEN 0 ELSE 1 END AS starts FROM habit_days))
GROUP BY user_id, event_type, run
""",
    "habit_streaks": """
SELECT user_id, event_type, max(CASE WHEN last_day = (SELECT max(day) FROM habit_days) THEN length ELSE 0 END) AS current_streak, max(length) AS longest_streak
FROM habit_runs GROUP BY user_id, event_type
""",
}
