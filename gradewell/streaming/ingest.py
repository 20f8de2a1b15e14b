"""Incremental cleaning of arriving exam records.

The row rules need no state, so the batch functions are used unchanged on a
stream; the staging table itself (term counters, first passes) is rebuilt from
the cleaned rows in batch, as every table here is.  Rows with a code outside its
domain are kept apart, not left out: one sink holds both halves, by the
partition column ``valid``, so each file is still cleaned and written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gradewell import types as t
from gradewell.operators.cleaning import unchecked_rows, valid_enums


def stream_judged_rows(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Cleaned rows of the Parquet files arriving in ``folder``, and whether their codes are ``valid``."""
    raw = spark.readStream.schema(t.STUDENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return unchecked_rows(raw).withColumn("valid", valid_enums())


def append_rows(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Clean everything that has arrived and append it to ``target``, each file once."""
    return (
        stream_judged_rows(spark, folder)
        .writeStream.format("parquet")
        .partitionBy("valid")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def appended_rows(spark: SparkSession, target: str, valid: bool = True) -> DataFrame:
    """The clean rows written so far, or the rejected ones; only their partition is read."""
    return spark.read.parquet(target).filter(f"valid = {str(valid).lower()}").drop("valid")
