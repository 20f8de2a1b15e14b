from __future__ import annotations

import random
import re

from helpers import ODD_ROWS, ascii_lower, odd_documents

from gradewell.llm import decontamination as dc

ITEMS = "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def brute_force(text, items, window, slop=0):
    found, hit, ids = words(text), set(), set()
    for item, item_text in items:
        asked = words(item_text)
        size = min(window, len(asked))
        for k in range(len(asked) - size + 1 if size else 0):
            rarest = asked[k : k + size]
            for start in range(len(found) - size + 1):
                if slop == 0 and found[start : start + size] == rarest:
                    hit |= set(range(start, start + size))
                    ids |= {str(item)} - {"None"}
    return sorted(hit), sorted(ids), len(found)


def random_tables(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "the"]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choices(vocabulary, k=n))
    items = [(k, text(draw.randint(0, 14))) for k in range(30)] + [(3, text(6)), (None, "the The THE"), (7, None)]
    docs = []
    for k in range(60):
        parts = [text(draw.randint(0, 30))]
        if draw.random() < 0.5:
            parts.append(draw.choice(items)[1] or "")
        docs.append((k, " ".join([*parts, text(3)])))
    return docs, items


def check(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = dc.search(dc.build_index(frame), spark.createDataFrame(items, ITEMS), 4, **options)
    got = {r.key: (list(r.hit_words), list(r["items"]), r.n_words) for r in found.collect()}
    assert got == {k: brute_force(t, items, 4) for k, t in docs}


def test_against_brute_force(spark, monkeypatch):
    docs, items = random_tables(1)
    check(spark, docs, items)
    check(spark, docs, items, block_chars=40)  # many blocks, merged per document


def test_words_of_bytes():
    text = "ABC-d9 \x00Éa b\x7f_z中\U0001f600 [x]"
    assert [w.decode() for w in dc.words(text.encode())] == words(text)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two xx three four"), (2, "two one three four"), (3, "one two"), (4, "one two three four")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "one two three four")], ITEMS)
    index = dc.build_index(docs)
    near = lambda slop: {r.key: list(r.hit_words) for r in dc.search(index, items, 4, slop).collect() if r.hit_words}
    assert near(0) == {4: [0, 1, 2, 3]}
    assert near(1) == {1: [0, 1, 3, 4], 2: [0, 1, 2, 3], 4: [0, 1, 2, 3]}


def near(places, terms, slop):
    """Whether some start puts every term on a place of its own, at most ``slop`` beside its offset."""
    def assign(start, k, used):
        return k == len(terms) or any(
            w == terms[k] and p not in used and abs(p - start - k) <= slop and assign(start, k + 1, used | {p})
            for p, w in enumerate(places)
        )
    return any(assign(start, 0, frozenset()) for start in range(-slop, len(places) + slop))


def test_a_word_stands_for_one_term(spark):
    draw = random.Random(5)
    docs = [(k, " ".join(draw.choices("xyz", weights=[3, 2, 1], k=draw.randint(1, 7)))) for k in range(60)]
    docs.append((60, "x y"))
    index = dc.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2))
    items = [(k, " ".join(draw.choices("xyz", weights=[3, 2, 1], k=4))) for k in range(8)] + [(8, "x x"), (9, "x x x")]
    for slop in (0, 1, 2):
        found = dc.search(index, spark.createDataFrame(items, ITEMS), 4, slop)
        got = {r.key: set(r["items"]) for r in found.collect()}
        assert got == {k: {str(i) for i, t in items if near(text.split(), t.split(), slop)} for k, text in docs}


def test_phrases_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id bigint, text string").coalesce(1)
    found = dc.search(dc.build_index(docs), spark.createDataFrame([(1, "a b c d"), (2, "b c")], ITEMS), 4)
    assert all(not r.hit_words for r in found.collect())


def test_odd_documents_and_items(spark):
    docs = odd_documents(spark)
    items = [(1, "one line of TEXT here"), (None, "a text without an id"), (2, None), (3, " ,.- "), (4, "wörds 中文 \U0001f600")]
    bench = spark.createDataFrame(items, ITEMS)
    found = dc.search(dc.build_index(docs), bench)
    got = sorted(((r.key, list(r.hit_words), list(r["items"]), r.n_words) for r in found.collect()), key=str)
    assert got == sorted(((r[0], *brute_force(r[1], items, 10)) for r in ODD_ROWS), key=str)
    clean = dc.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in clean.collect()) == [0, 2, 3, 4, 5, 7]
    assert dc.search(dc.build_index(docs), bench.limit(0)).filter("size(hit_words) > 0").count() == 0
    assert dc.search(dc.build_index(docs.limit(0)), bench).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).count() == 10


def test_many_contaminated_texts_are_joined_by_sorting(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    docs = spark.createDataFrame([(k, f"text {k} with words") for k in range(20)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "text 3 with words"), (2, "4 with")], ITEMS)
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench).collect()) == [k for k in range(20) if k not in (3, 4)]
