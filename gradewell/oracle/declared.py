"""The declared data checks as the statements know them, apart from the engine's own list."""

# --- fixed values: column, check and its argument by table ------------------------
CHECKS: dict[str, tuple] = {
    "dim_students": (
        ("student_id", "not_null", None),
        ("graduation_flag", "not_null", None),
        ("year_of_matriculation", "not_null", None),
        ("semester_of_matriculation", "not_null", None),
        ("study_regulations_year", "not_null", None),
        ("field_of_study", "not_null", None),
        ("terms_taken_total_count", "not_null", None),
        ("inactivity_flag", "not_null", None),
        ("student_id", "unique", None),
        ("semester_of_matriculation", "accepted_values", ("WiSe", "SoSe")),
        ("study_regulations_year", "accepted_values", (11, 18)),
        ("graduation_flag", "accepted_values", (True, False)),
        ("inactivity_flag", "accepted_values", (True, False)),
    ),
    "stg_students_with_credits": (
        ("student_id", "not_null", None),
        ("module_number", "not_null", None),
        ("exam_status", "not_null", None),
        ("semester_type", "not_null", None),
        ("year", "not_null", None),
        ("term_counter", "not_null", None),
        ("credits_earned", "not_null", None),
        ("match_quality", "not_null", None),
        ("module_not_in_plan", "not_null", None),
        ("module_title", "not_null", None),
        ("tries_count", "not_null", None),
        ("withdrawal_count", "not_null", None),
        ("sanity_check", "not_null", None),
        ("exam_status", "accepted_values", ("bestanden", "nicht bestanden", "abgemeldet")),
        ("semester_type", "accepted_values", ("WiSe", "SoSe")),
        ("match_quality", "accepted_values", (0, 1, 2, 3)),
        ("module_not_in_plan", "accepted_values", (True, False)),
        ("sanity_check", "accepted_values", (True, False)),
        ("credits_earned", "between", (0, 30)),
        ("tries_count", "between", (1, 20)),
        ("withdrawal_count", "between", (0, 20)),
    ),
    "dim_students_with_credits": (
        ("student_id", "not_null", None),
        ("graduation_flag", "not_null", None),
        ("year_of_matriculation", "not_null", None),
        ("semester_of_matriculation", "not_null", None),
        ("study_regulations_year", "not_null", None),
        ("field_of_study", "not_null", None),
        ("terms_taken_total_count", "not_null", None),
        ("credits_earned_total_count", "not_null", None),
        ("passed_xwm_xzm_count", "not_null", None),
        ("total_credits_with_xwm_xzm_bonus", "not_null", None),
        ("sanity_check", "not_null", None),
        ("student_id", "unique", None),
        ("semester_of_matriculation", "accepted_values", ("WiSe", "SoSe")),
        ("study_regulations_year", "accepted_values", (11, 18)),
        ("graduation_flag", "accepted_values", (True, False)),
        ("sanity_check", "accepted_values", (True, False)),
        ("credits_earned_total_count", "between", (0, 150)),
    ),
    "dim_zeit": (
        ("time_id", "not_null", None),
        ("year", "not_null", None),
        ("semester_type", "not_null", None),
        ("semester_type_numeric", "not_null", None),
        ("time_label", "not_null", None),
        ("time_id", "unique", None),
        ("semester_type", "accepted_values", ("WiSe", "SoSe")),
        ("semester_type_numeric", "accepted_values", (0, 1)),
    ),
    "dim_modul": (
        ("module_id", "not_null", None),
        ("module_title", "not_null", None),
        ("module_acronym", "not_null", None),
        ("graduation_year", "not_null", None),
        ("graduation_semester", "not_null", None),
        ("module_key", "not_null", None),
        ("field_of_study", "not_null", None),
        ("module_key", "unique", None),
        ("graduation_year", "accepted_values", (11, 18)),
        ("graduation_semester", "accepted_values", ("WiSe", "SoSe")),
        ("field_of_study", "accepted_values", (71, 72, 73, 74)),
    ),
    "fact_kpi": (
        ("student_id", "not_null", None),
        ("module_id", "not_null", None),
        ("term_counter", "not_null", None),
        ("passed_flag", "not_null", None),
        ("credits_earned", "not_null", None),
        ("passed_flag", "accepted_values", (0, 1)),
        ("credits_earned", "between", (0, 30)),
        ("student_id", "relationships", ("dim_students", "student_id")),
        ("module_id", "relationships", ("dim_modul", "module_id")),
        ("time_id", "relationships", ("dim_zeit", "time_id")),
    ),
    "student_kpi": (
        ("student_id", "not_null", None),
        ("weighted_avg_grade", "between", (1, 4)),
        ("median_grade", "between", (1, 5)),
        ("student_id", "relationships", ("dim_students", "student_id")),
    ),
    "modul_kpi": (
        ("module_id", "not_null", None),
        ("module_id", "relationships", ("dim_modul", "module_id")),
    ),
    "studiengang_kpi": (
        ("students_total_count", "not_null", None),
        ("weighted_avg_program_grade", "not_null", None),
        ("median_program_grade", "not_null", None),
    ),
    "studiengangsvergleich_kpi": (
        ("field_of_study", "not_null", None),
        ("year_of_matriculation", "not_null", None),
        ("matriculations_count", "not_null", None),
        ("field_of_study", "accepted_values", (71, 72, 73)),
        ("year_of_matriculation", "between", (11, 21)),
    ),
}
# --- end of fixed values ------------------------------------------------------------
