"""The corpus pipeline: every stage against its operator's brute force, and the whole run."""

from __future__ import annotations

import pytest
from helpers import components, odd_documents
from test_decontamination import brute_force as contaminated
from test_line_dedup import brute_force as stripped
from test_simhash import fingerprint

import corpus_pipeline
from gradewell.llm import nb_svm, queries
from gradewell.llm.common import stored


@pytest.fixture(scope="module")
def steps(spark, small_folder):
    """Rows before the first stage and after every stage."""
    docs = queries.table(spark, small_folder, "documents")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], small_folder), "step"))
    return found


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_schemas(steps):
    assert all(s.schema.names == steps[0].schema.names for s in steps[:-1])
    assert [t for _, t in steps[0].dtypes] == [t for _, t in steps[4].dtypes]


def test_rejected_documents_go(spark, small_folder, steps):
    labels = queries.table(spark, small_folder, "labels")
    judged = nb_svm.judge(steps[0], labels, "quality", 5, 0, 0.3)
    assert texts(steps[1]) == {r.doc_id: r.text for r in judged.filter("predicted = 1").collect()}


def test_shared_lines_go(steps):
    before = texts(steps[1])
    assert texts(steps[2]) == dict(zip(before, (row[0] for row in stripped(before.values(), 10))))
    assert all(r.n_chars == len(r.text or "") for r in steps[2].collect())


def test_one_of_each_group_stays(steps):
    before = texts(steps[2])
    prints = {k: fingerprint(t) for k, t in before.items()}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    group = components(prints, linked)
    assert texts(steps[3]) == {k: t for k, t in before.items() if group[k] == k}


def test_benchmark_passages_go(spark, small_folder, steps):
    items = [(r.item_id, r.text) for r in queries.table(spark, small_folder, "benchmark").collect()]
    before = texts(steps[3])
    assert texts(steps[4]) == {k: t for k, t in before.items() if not contaminated(t, items, 10)[0]}
    assert 0 < len(texts(steps[4])) < len(before)


def test_mix_covers_what_is_left(steps):
    assert {r.doc_id for r in steps[5].collect()} == set(texts(steps[4]))
    assert steps[5].columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_run_is_the_stages(spark, small_folder, steps):
    assert sorted(corpus_pipeline.run(spark, small_folder).collect()) == sorted(steps[5].collect())


def test_odd_documents(spark, small_folder):
    docs = odd_documents(spark)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, small_folder), "odd")
            assert frame.columns == docs.columns, name
        assert corpus_pipeline.mix(spark, frame, small_folder).count() == frame.count()
