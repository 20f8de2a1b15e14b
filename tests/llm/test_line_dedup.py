from __future__ import annotations

from collections import Counter

import pytest
from helpers import ODD_ROWS, ascii_lower, odd_documents
from pyspark.sql import functions as F

from gradewell.llm import line_dedup


def key_of(line: str) -> str:
    return ascii_lower(line.strip(" \t\n\x0b\f\r"))


def brute_force(texts, min_docs):
    counts = Counter(k for t in texts for k in {key_of(line) for line in (t or "").split("\n")} if k)
    for text in texts:
        lines = (text or "").split("\n")
        kept = [line for line in lines if counts[key_of(line)] < min_docs]
        yield "\n".join(kept) if len(kept) < len(lines) else text, len(lines), len(lines) - len(kept)


def rows_of(frame):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in frame.collect()), key=str)


@pytest.mark.parametrize("broadcast_rows", [line_dedup.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", broadcast_rows)
    texts = [f"own line {k}\n SHARED a \nshared A\n\nshared by {k % 3}\r\nÉ up" for k in range(9)] + [None, "", "Shared A", "é up"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = sorted(((k, *row) for k, row in enumerate(brute_force(texts, 4))), key=str)
    assert rows_of(line_dedup.dedup_lines(docs, 4)) == expected
    parts = [docs.filter(F.col("doc_id") % 3 == k) for k in range(3)]
    assert rows_of(line_dedup.dedup_lines(docs, 4, batches=parts)) == expected


def test_odd_documents(spark):
    docs = odd_documents(spark)
    expected = sorted(((r[0], *row) for r, row in zip(ODD_ROWS, brute_force([r[1] for r in ODD_ROWS], 2))), key=str)
    found = line_dedup.dedup_lines(docs, 2)
    assert rows_of(found) == expected
    assert {r["a.b"] for r in found.collect()} == {14}
    frequent = line_dedup.frequent_keys([docs], 2)
    assert line_dedup.strip(docs, frequent).columns == docs.columns
    assert line_dedup.dedup_lines(docs.limit(0), 2).count() == 0


def counts(spark, runs):
    return Counter({(r.h1, r.h2): r.n for t in runs.runs() for r in spark.table(t).collect()})


def test_levels_are_compacted_and_keep_their_sums(spark):
    runs = line_dedup.LineRuns(spark, fanout=3, buckets=2)
    sizes = []
    for k in range(7):
        runs.add(spark.createDataFrame([(1, f"common\nline {k}"), (2, "common")], "doc_id bigint, text string"))
        sizes.append([len(level) for level in runs.levels])
    assert sizes == [[1], [2], [0, 1], [1, 1], [2, 1], [0, 2], [1, 2]]
    spark_total = sum(r.n for t in runs.runs() for r in spark.table(t).collect())
    table = runs.compact()
    assert runs.runs() == [table]
    merged = [r.n for r in spark.table(table).collect()]
    assert sorted(merged) == [1] * 7 + [14] and sum(merged) == spark_total


def test_runs_are_sorted_buckets(spark):
    runs = line_dedup.LineRuns(spark, buckets=2)
    runs.add(spark.createDataFrame([(k, f"line {k}") for k in range(50)], "doc_id bigint, text string"))
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {runs.runs()[0]}").collect()}
    assert details["Num Buckets"] == "2" and details["Sort Columns"] == "[`h1`, `h2`]"


def test_each_batch_keeps_only_new_lines(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    seen, batches = set(), [["a\nb\na", "B"], ["c\nb", " a "], [None, "c\nd\nD"], ["e", "d"]]
    for texts in batches:
        batch = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        found = {(r.doc_id, r.place, r.line) for r in runs.new_lines(batch).collect()}
        lines = [(k, p, line) for k, t in enumerate(texts) for p, line in enumerate((t or "").split("\n"))]
        assert found == {x for x in lines if key_of(x[2]) not in seen}
        seen |= {key_of(x[2]) for x in lines if key_of(x[2])}


def test_known_lines_are_merged_without_moving_the_runs(spark):
    runs = line_dedup.LineRuns(spark, buckets=4)
    runs.add(spark.createDataFrame([(1, "a\nb")], "doc_id bigint, text string"))
    table = spark.table(runs.runs()[0]).select("h1", "h2")
    lines = spark.range(9).selectExpr("id AS h1", "-id AS h2").repartition(4, "h1", "h2")
    plan = lines.join(table.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_files_are_dealt_to_batches_by_name(spark, tmp_path):
    path = f"{tmp_path}/with blank/ü%20.parquet"
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('line ', id % 7) AS text").repartition(9)
    docs.write.parquet(path)
    batches = line_dedup.file_batches(spark, path)
    assert sum(len(b.inputFiles()) > 0 for b in batches) > 1
    rows = [r.doc_id for b in batches for r in b.collect()]
    assert sorted(rows) == list(range(50)) and all(b.columns == ["doc_id", "text"] for b in batches)


def test_a_key_is_in_one_run_and_later_counts_are_additions(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    texts = [f"common\nline {k}\nline {k // 2}\nline {k // 5}" for k in range(11)]
    for k, text in enumerate(texts):
        runs.add(spark.createDataFrame([(k, text)], "doc_id bigint, text string"))
        keys = [(r.h1, r.h2) for t in runs.key_runs() for r in spark.table(t).collect()]
        assert len(keys) == len(set(keys)) and all(len(level) < 2 for level in runs.levels + runs.additions)
    assert len(runs.levels) > 2 and any(runs.additions)
    expected = Counter(k for text in texts for k in {key_of(line) for line in text.split("\n")})
    runs.compact()
    assert sorted(counts(spark, runs).values()) == sorted(expected.values())
    runs.close()
    assert not runs.runs() and not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def test_the_corpus_goes_batch_by_batch_through_the_anti_join(spark, monkeypatch, tmp_path):
    path = f"{tmp_path}/documents"
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('own ', id, '\nline ', id % 40, '\nall') AS text")
    docs.repartition(24).write.parquet(path)
    plans, levels = [], []
    unknown, close = line_dedup.LineRuns.unknown, line_dedup.LineRuns.close

    def watched(self, lines, tables):
        found = unknown(self, lines, tables)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    def closed(self):
        levels.append(self.written)
        close(self)

    monkeypatch.setattr(line_dedup.LineRuns, "unknown", watched)
    monkeypatch.setattr(line_dedup.LineRuns, "close", closed)
    batches = line_dedup.scan_batches(spark.read.parquet(path))
    assert len(batches) == line_dedup.BATCHES > line_dedup.FANOUT
    frequent = line_dedup.frequent_keys(batches, 8)
    assert sorted(r.n for r in frequent.collect()) == sorted(
        [300] + [len(range(k, 300, 40)) for k in range(40) if len(range(k, 300, 40)) >= 8]
    )
    assert len(plans) == 2 * (line_dedup.BATCHES - 1) and levels[0] > line_dedup.BATCHES
    assert all("LeftAnti" in p and "SortMergeJoin" in p and "Exchange" not in p for p in plans)


def test_a_frame_that_is_no_scan_is_one_batch(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert line_dedup.scan_batches(docs.groupBy("doc_id", "text").count()) != [] and len(line_dedup.scan_batches(docs)) == 1
    named = spark.createDataFrame([(1, "a", "x")], "doc_id bigint, text string, _metadata string")
    assert len(line_dedup.scan_batches(named)) == 1
