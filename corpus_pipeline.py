"""From raw documents to a training mix: the stages of the corpus pipeline, each one operator of ``gradewell.llm``.

Every stage works on all documents its predecessor kept; its result is written as Parquet and read again as the
documents of the next one.  All stages but the last return the columns of the documents they are given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.llm import decontamination, line_dedup, mixing, nb_svm, queries, simhash
from gradewell.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it is trained on the labelled ones that are not held out."""
    labels = queries.table(spark, sf_dir, "labels")
    model = nb_svm.train(docs, labels, "quality", queries.QUALITY_FOLDS, queries.QUALITY_HELD_OUT)
    return nb_svm.accepted(docs, model, queries.THRESHOLD)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines many of them share; ``n_chars`` follows the text.  No document goes."""
    frequent = line_dedup.frequent_keys(line_dedup.scan_batches(docs), queries.LINE_DOCUMENTS, queries.LINE_CHARS)
    stripped = line_dedup.strip(docs, frequent)
    if "n_chars" in docs.columns:
        stripped = stripped.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return stripped


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id."""
    return simhash.dedup(docs, simhash.SHINGLE, simhash.DISTANCE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words the training mix takes of every document that is left."""
    plan = mixing.mix_plan(docs, queries.SOURCE_WEIGHTS, queries.MAX_EPOCHS, queries.MIX_SEED)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
]

#: SQL cannot express the trained stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
