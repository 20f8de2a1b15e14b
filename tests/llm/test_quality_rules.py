from __future__ import annotations

import random
import re
from collections import Counter

from helpers import ODD_ROWS, odd_documents
from pyspark.sql import functions as F

from gradewell.llm import quality_rules as q

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {p for k, w in enumerate(windows) if counts[w] > 1 for p in range(k, k + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_metrics_of_random_texts(spark):
    draw = random.Random(9)
    texts = [draw.choice([" ", "\n", " \n "]).join(draw.choices(["a", "b", "#|", "é ", "the"], k=draw.randint(0, 40))) for _ in range(200)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: tuple(r[m] for m in METRICS) for r in q.judge(frame, METRICS).collect()}
    assert found == {k: brute_force(t) for k, t in enumerate(texts)}


def test_odd_documents(spark):
    docs = odd_documents(spark)
    judged = q.judge(docs, METRICS).collect()
    assert sorted(tuple(r[m] for m in METRICS) for r in judged) == sorted(brute_force(r[1]) for r in ODD_ROWS)
    assert {r["a.b"] for r in judged} == {14}
    assert all(r.base_failed and not r.kept for r in judged if r.doc_id in (2, 3, 4))
    assert q.judge(docs.limit(0), METRICS).count() == 0
    both = q.cascade(docs)
    assert sorted(r.kept for r in both.collect()) == sorted(r.kept for r in judged)


def test_order_changes_no_verdict(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    verdicts = [q.first_failed(order, lambda m: q.METRICS[m](text)).isNull() for order in (q.RULES, q.RULES[::-1])]
    assert docs.filter(verdicts[0] != verdicts[1]).count() == 0


def test_rules_are_ordered_by_rejections_per_cost(spark):
    rules = [q.Rule(n, (), lambda: F.lit(False)) for n in "abc"]
    given = [q.Estimate(rules[0], 2.0, 0.5), q.Estimate(rules[1], 1.0, 0.5), q.Estimate(rules[2], 0.1, 0.0)]
    assert [r.name for r in q.ordered(given)] == ["b", "a", "c"]
    texts = spark.createDataFrame([("x " * 20,), ("y",), ("",)], "text string")
    found = {e.rule.name: e.rejected for e in q.estimate(texts)}
    assert found["few_words"] == 2 / 3 and found["repeated_words"] == 1 / 3


def test_later_rules_are_not_evaluated_after_a_rejection(spark):
    refuse = q.Rule("refuse", ("n_words",), lambda n: n < 10)
    explode = q.Rule("explode", ("n_words",), lambda n: F.when(n < 10, F.raise_error(F.lit("asked")).cast("boolean")).otherwise(False))
    frame = spark.createDataFrame([("few words",), ("many " * 12,)], "text string")
    kept = q.first_failed([refuse, explode], lambda m: q.METRICS[m](F.col("text"))).isNull()
    assert sorted(r.kept for r in frame.select(kept.alias("kept")).collect()) == [False, True]


def test_good_documents_are_kept(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    judged = q.judge(docs, METRICS).join(spark.read.parquet(f"{small_folder}/labels.parquet"), "doc_id")
    shares = {r.quality: r.s for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert shares[1] > 0.9 and shares[0] < 0.2
