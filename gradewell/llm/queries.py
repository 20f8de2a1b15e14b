"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.llm import (
    alignment, decontamination, line_dedup, mixing, nb_svm, packing, preferences, quality_rules, simhash, token_counts, toxicity,
    url_filter, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Weights of the sources in the order of code points, repeating, and the most a source is repeated.
SOURCE_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3.0
MIX_SEED = 20
#: Listed URL prefixes and what is done with them.
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
QUALITY_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: A line goes when its key has so many characters and is found in so many documents.
LINE_CHARS = 1
LINE_DOCUMENTS = 10
#: Rows whose CRC-32 of the key leaves this remainder are not learnt from; scores from THRESHOLD on are label 1.
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Leading components of the embeddings that are returned.
COMPONENTS = 8
#: Vocabularies that are aligned.
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Vocabulary of the packed documents, and the id that closes one.
PACKED_VOCABULARY, CLOSING_ID = "word_bpe_49k.json", 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def count_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, special strings handled as the library does by default."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, VOCABULARY, TOKEN_LIMIT).drop("text")


def link_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), simhash.SHINGLE, simhash.DISTANCE)
    return found.select("doc_id", "fingerprint", "component_id")


def format_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt and completions of every conversation against itself with its neighbour's answer."""
    pairs = preferences.mismatched_pairs(table(spark, folder, "conversations"))

    def spans(mask: str) -> Column:
        each = F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",").alias(mask)

    return preferences.format_pairs(pairs).select(
        F.col("pair").alias("conv_id"), "prompt_turns", "prompt", "chosen", spans("chosen_mask"), "rejected",
        spans("rejected_mask"),
    )


def dedup_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that many documents share."""
    path = f"{folder}/documents.parquet"
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stripped = line_dedup.dedup_lines(docs, LINE_DOCUMENTS, LINE_CHARS, line_dedup.file_batches(spark, path))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return stripped.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = table(spark, folder, "documents")
    plan = mixing.mix_plan(docs, SOURCE_WEIGHTS, MAX_EPOCHS, MIX_SEED)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def filter_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The rule that decides on every page, and its verdict."""
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a window of a benchmark item, and the items found."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.search(decontamination.build_index(docs), table(spark, folder, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def classify_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, from a model that has not seen the held-out fifth."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = nb_svm.judge(docs, table(spark, folder, "labels"), "quality", QUALITY_FOLDS, QUALITY_HELD_OUT, THRESHOLD)
    return judged.select("doc_id", "held_out", "score", "predicted")


def judge_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of every document and the verdict of the cascade."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, QUALITY_METRICS).select("doc_id", *QUALITY_METRICS, "base_failed", "kept")


def score_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, from a model that has not seen the held-out quarter."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = toxicity.judge(docs, table(spark, folder, "labels"), "toxic", TOXIC_FOLDS, TOXIC_HELD_OUT, THRESHOLD)
    return judged.select("doc_id", "held_out", "score", "predicted")


def whiten_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened embeddings, one row a component."""
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding", COMPONENTS)
    each = found.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("place")).alias("explained"), "identity_error",
    )


def align_vocabularies(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two vocabularies meet in every document, and how usual these meetings are in all of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = alignment.align(docs, BYTE_VOCABULARY, PIECE_VOCABULARY, digest_groups=True)
    return found.drop("text").withColumnRenamed("groups", "groups_sha256")


def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as pieces of sequences with little padding."""
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), PACKED_VOCABULARY, CLOSING_ID)


QUERIES: dict[str, Query] = {
    "op1_url_filter": filter_urls,
    "op2_token_counts": count_tokens,
    "op3_simhash": link_near_duplicates,
    "op4_preference_format": format_preferences,
    "op5_line_dedup": dedup_lines,
    "op6_mix_sources": mix_sources,
    "op7_decontamination": decontaminate,
    "op8_quality_classifier": classify_quality,
    "op9_quality_rules": judge_quality,
    "op10_toxicity": score_toxicity,
    "op11_whitening": whiten_embeddings,
    "op12_token_alignment": align_vocabularies,
    "op13_packing": pack_documents,
}
