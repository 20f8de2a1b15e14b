"""The fact table of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell import types as t
from gradewell.functions.numeric import flag


def fact_kpi(enriched: DataFrame, modules: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per attempt of a catalogued module, with the keys of the dimensions.

    The term table has at most ``MAX_TERMS`` rows; the module keys follow the
    curriculum, so Spark's own size check decides how that join runs.
    """
    return (
        enriched.join(modules.select("module_key", "module_id"), "module_key")
        .join(F.broadcast(terms.select("year", "semester_type", "time_id")), ["year", "semester_type"], "left")
        .select(
            "student_id",
            "module_id",
            "time_id",
            F.col("grade").cast("double").alias("grade_numeric"),
            flag(F.col("exam_status") == t.PASSED).alias("passed_flag"),
            "credits_earned",
            "exam_status",
            "tries_count",
            "withdrawal_count",
            "term_counter",
        )
    )
