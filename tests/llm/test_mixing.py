from __future__ import annotations

import pytest

from collections import Counter

from helpers import odd_documents
from pyspark.sql import functions as F

from gradewell.llm import mixing


def loop(sizes, weights, most):
    """Water-filling as it is defined: clamp, share the rest out again, until nothing is above its cap."""
    clamped, total = set(), sum(sizes)
    while True:
        rest = total - sum(most * sizes[k] for k in clamped)
        free = sum(w for k, w in enumerate(weights) if k not in clamped)
        target = [most * s if k in clamped else weights[k] * rest / free for k, s in enumerate(sizes)]
        above = {k for k, t in enumerate(target) if k not in clamped and t > most * sizes[k]}
        if not above:
            return target
        clamped |= above


def test_water_filling_equals_the_loop(spark):
    import random

    draw = random.Random(8)
    for _ in range(4):
        n = draw.randint(1, 12)
        sizes = [draw.choice([0, 1, 10, 1000, 100_000]) + draw.randint(0, 9) for _ in range(n)]
        sizes[0] += 1
        weights = [draw.choice([0.5, 1.0, 2.0, 5.0]) for _ in range(n)]
        rows = [(f"s{k:02}", w, s) for k, (s, w) in enumerate(zip(sizes, weights))]
        frame = spark.createDataFrame(rows, "source string, weight double, source_size bigint")
        found = [r.target for r in mixing.water_fill(frame, 3.0).orderBy("source").collect()]
        expected = loop(sizes, weights, 3.0)
        assert all(abs(a - b) <= 1e-6 * max(1.0, b) for a, b in zip(found, expected))
        assert abs(sum(found) - sum(sizes)) < 1e-3


def test_taken_words_come_near_the_target_in_every_slicing(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").withColumn("source", F.element_at(F.split("source", "src"), 2) % 4)
    for rows_per_slice in (10, 10_000):
        plan = mixing.mix_plan(docs, (5, 2, 1), rows_per_slice=rows_per_slice)
        for r in plan.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k"), F.max("size").alias("m")).collect():
            assert abs(r.k - r.t) <= max(0.1 * r.t, r.m)
        assert plan.filter("taken > 3 * size").count() == 0
        assert plan.exceptAll(mixing.mix_plan(docs, (5, 2, 1), rows_per_slice=rows_per_slice)).count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = mixing.mix_plan(docs, (5, 2, 1)).collect()
    assert len(rows) == 10
    assert {r["size"] for r in rows if r.doc_id in (2, 3, 4)} == {0}
    sources = {r.source: (r.source_size, r.target) for r in rows}
    assert set(sources) == {"a", "b", "c", None}
    assert sources[None] == (1, 3.0)  # one word, four sources of weights 5, 2, 1, 5: capped
    assert all(r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in rows)
    assert mixing.mix_plan(docs.limit(0), (5, 2, 1)).count() == 0
    only_empty = docs.filter("doc_id IN (2, 3, 4)")
    assert {(r.target, r.taken) for r in mixing.mix_plan(only_empty, (5, 2, 1)).collect()} == {(0.0, 0)}


def test_documents_are_repeated_whole(spark):
    docs = spark.createDataFrame([(k, "one two three", "a" if k < 4 else "b") for k in range(44)], "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs, (5, 1))
    assert mixed.columns == docs.columns
    taken = Counter(r.source for r in mixed.collect())
    plan = mixing.mix_plan(docs, (5, 1))
    assert taken == {r.source: r.n for r in plan.groupBy("source").agg((F.sum("taken") / 3).cast("int").alias("n")).collect()}
    assert taken["a"] == 12
    odd = odd_documents(spark)
    assert mixing.mix(odd, (5, 2, 1)).columns == odd.columns


def relative_misses(plan):
    found = plan.filter("target > 0").groupBy("source").agg((F.abs(F.sum("taken") - F.first("target")) / F.first("target")).alias("miss"))
    return {r.source: r.miss for r in found.collect()}


def test_target_is_met_where_one_document_holds_half_the_words(spark):
    rows = [(k * 1000 + j, "w " * (n if j else 299 * n), f"s{k}") for k, n in enumerate((1, 2, 3, 4, 5, 7)) for j in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for rows_per_slice in (30, 10_000):
        found = relative_misses(mixing.mix_plan(docs, (5, 2, 1), rows_per_slice=rows_per_slice))
        assert len(found) == 6 and max(found.values()) < 0.02, found
        assert mixing.mix_plan(docs, (5, 2, 1), rows_per_slice=rows_per_slice).filter("taken > 3 * size").count() == 0


def test_target_is_met_by_sources_of_ten_documents(spark, small_folder):
    found = relative_misses(mixing.mix_plan(spark.read.parquet(f"{small_folder}/documents.parquet"), (5, 2, 1), seed=20))
    assert len(found) == 20 and max(found.values()) < 0.03, found


def plain_targets(sizes, weights, most):
    """The loop that water-filling is defined by; sizes by source in order."""
    total, clamped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[k] for k in clamped)
        share = sum(weights[k] for k in range(len(sizes)) if k not in clamped)
        target = [most * s if k in clamped else weights[k] * rest / share for k, s in enumerate(sizes)]
        over = {k for k, t in enumerate(target) if t > most * sizes[k] and k not in clamped}
        if not over:
            return target
        clamped |= over


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_registered_query_meets_its_targets(spark, small_folder, folder):
    import re
    from pathlib import Path

    from gradewell.llm import queries

    folder = str(Path(small_folder).parent / folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").toPandas()
    docs["words"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in docs.text]
    found = queries.QUERIES["op6_mix_sources"](spark, folder).toPandas()
    assert sorted(zip(found.doc_id, found["size"])) == sorted(zip(docs.doc_id, docs.words))
    whole = found.merge(docs[["doc_id", "source"]], on="doc_id")
    by_source = whole.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    by_source = by_source.sort_index()  # code points, null last
    weights = [queries.SOURCE_WEIGHTS[k % 3] for k in range(len(by_source))]
    assert by_source.target.tolist() == pytest.approx(plain_targets(by_source["size"].tolist(), weights, queries.MAX_EPOCHS))
    assert (abs(by_source.taken - by_source.target) <= 0.02 * by_source.target + 1).all()
    copies = whole.taken / whole["size"].clip(lower=1)
    rate = whole.target / whole.source_size
    assert ((copies == rate.floordiv(1)) | (copies == rate.floordiv(1) + 1) | (whole["size"] == 0)).all() and copies.max() <= 3
    again = queries.QUERIES["op6_mix_sources"](spark, folder).toPandas()
    assert sorted(zip(again.doc_id, again.taken)) == sorted(zip(found.doc_id, found.taken))
