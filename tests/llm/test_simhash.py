from __future__ import annotations

import random
import re

import xxhash
from helpers import ascii_lower, components, odd_documents

from gradewell.llm import simhash
from gradewell.llm.components import components as graph_components


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check(spark, docs):
    rows = docs.collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = components(prints, linked)
    assert found == {k: (format(p, "016x"), expected[k]) for k, p in prints.items()}


def test_whole_small_table(spark, small_folder):
    check(spark, spark.read.parquet(f"{small_folder}/documents.parquet"))


def test_links_of_close_fingerprints(spark):
    """Chains and clusters of fingerprints a few bits apart; no pair is missed, none too far is taken."""
    draw = random.Random(4)
    prints = {draw.getrandbits(64) for _ in range(20)}
    for start in list(prints):
        for _ in range(12):
            start ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5)))
            prints.add(start)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    assert found == {(a, b) for a in signed for b in signed if a > b and near(a, b)}


def test_each_pair_comes_once(spark):
    frame = spark.createDataFrame([(p,) for p in (0, 1, 3, 7)], "fp bigint")
    assert simhash.links(frame).count() == 6


def test_components_of_a_long_chain(spark):
    chain = [(k + 1, k) for k in range(200)] + [(500, 400), (401, 400), (500, 401)]
    found = {r.node: r.root for r in graph_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**{k + 1: 0 for k in range(200)}, 401: 400, 500: 400}
    assert graph_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == 10
    zero = {(r.doc_id, r.component_id) for r in found if int(r.fingerprint, 16) == 0}
    assert zero == {(2, 2), (3, 2), (4, 2), (None, 2)}
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, k) for k in (1, 2, 5, 6, 7)] + [(True, 0)]
    assert simhash.dedup(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_documents_without_any_id(spark):
    docs = spark.createDataFrame([(None, "one text here now"), (None, "one text here now"), (None, "something else entirely")],
                                 "doc_id bigint, text string")
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}
    assert sorted(r.text for r in simhash.dedup(docs).collect()) == ["one text here now", "something else entirely"]


def test_hot_fingerprint_is_spread(spark, monkeypatch):
    from gradewell.operators import skew

    monkeypatch.setattr(simhash, "hot_keys", lambda counted, keys, total: skew.hot_keys(counted, keys, total, 3))
    docs = spark.createDataFrame([(k, "same words in all of them") for k in range(40)] + [(99, "other words here")],
                                 "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert found == {**dict.fromkeys(range(40), 0), 99: 99}
