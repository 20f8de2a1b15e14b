"""The two trained operators, by held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import odd_documents

from gradewell.llm import nb_svm, toxicity, training

LABELS = "doc_id bigint, quality int, toxic int"


def area(scores, y):
    """Share of pairs in the right order."""
    scores, y = np.array(scores), np.array(y)
    good, bad = scores[y == 1], scores[y == 0]
    return np.mean((good[:, None] > bad) + 0.5 * (good[:, None] == bad))


def test_quality_on_held_out_rows(spark, small_folder):
    folder = small_folder.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = nb_svm.judge(docs, labels, "quality", 5, 0, 0.3).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert area([r.score for r in held], [r.quality for r in held]) > 0.95
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.95


def test_held_out_labels_are_not_read(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(50)] + [(None, 1, 1), (3, None, 1)], LABELS)
    known = {r.key for r in training.known_labels(labels, "quality", "doc_id", 5, 0).collect()}
    assert known == {k for k in range(50) if zlib.crc32(str(k).encode()) % 5}


def test_descent_finds_the_margin():
    draw = np.random.default_rng(1)
    rows = [np.flatnonzero(draw.random(30) < 0.3) for _ in range(200)]
    y = np.array([int(3 in r) for r in rows])
    weights, bias = nb_svm.dual_coordinate_descent(rows, np.ones(30), y, cost=1.0, epochs=50)
    margins = np.array([weights[r].sum() + bias for r in rows])
    assert ((margins > 0) == (y == 1)).all() and np.argmax(weights) == 3


def test_calibration_follows_the_share():
    draw = np.random.default_rng(2)
    y = draw.integers(0, 2, 4000)
    margins = draw.normal(2 * y - 1, 1.0)
    slope, shift = training.calibrate(margins, y, 0.5)
    assert abs(slope - 2) < 0.2 and abs(shift) < 0.15
    assert training.calibrate(margins, y, 0.1)[1] < shift
    assert training.calibrate(np.zeros(0), np.zeros(0, int), 0.5) == (0.0, 0.0)


def toxic_documents():
    """Clean prose, and prose with one of few insults in it; half of those that are held out misspell it."""
    draw = random.Random(7)
    syllables = ["ther", "on", "an", "re", "ed", "in", "er", "st", "ou", "ti"]
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 3)))
    insults = ["scoundrelly", "blockheaded", "wretchedness"]
    rows, labels = [], []
    for k in range(600):
        text = [word() for _ in range(draw.randint(20, 120))]
        toxic = k % 3 == 0
        if toxic:
            insult = draw.choice(insults)
            if zlib.crc32(str(k).encode()) % 4 == 2 and draw.random() < 0.5:
                at = draw.randint(3, 6)
                insult = insult[:at] + draw.choice("xzq") + insult[at:]
            text.insert(draw.randrange(len(text)), insult + draw.choice(["", "!", "."]))
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_finds_unseen_misspellings(spark):
    rows, labels = toxic_documents()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, LABELS)
    found = toxicity.judge(docs, known, "toxic", 4, 2, 0.3).join(known, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 100
    assert area([r.score for r in held], [r.toxic for r in held]) > 0.95
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.9


def test_gradients_are_those_of_the_loss():
    corpus = toxicity.Corpus(["some words here", "other words there again", ""])
    draw = np.random.default_rng(3)
    vectors, layer, bias = draw.normal(size=(toxicity.BUCKETS, 3)), draw.normal(size=(3, 2)), draw.normal(size=2)
    y, weight, chosen = np.array([1, 0, 1]), np.array([0.2, 0.5, 0.3]), np.arange(3)

    def loss(v, w, b):
        word = np.add.reduceat(v[corpus.bags], corpus.bag_starts) / corpus.bag_sizes[:, None]
        means = np.array([word[corpus.words[s : s + n]].mean(axis=0) if n else np.zeros(3) for s, n in zip(corpus.starts, corpus.sizes)])
        logits = means @ w + b
        return float(weight @ (np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(3), y]))

    got = toxicity.gradients(corpus, chosen, y, weight, vectors, layer, bias)
    for k, at in ((0, (corpus.bags[0], 1)), (0, (corpus.bags[-1], 2)), (1, (2, 0)), (2, (1,))):
        parameters = [vectors.copy(), layer.copy(), bias.copy()]
        parameters[k][at] += 1e-5
        up = loss(*parameters)
        parameters[k][at] -= 2e-5
        assert abs((up - loss(*parameters)) / 2e-5 - got[k][at]) < 1e-6


def test_score_does_not_depend_on_where_a_passage_starts():
    buckets = np.zeros(toxicity.BUCKETS)
    buckets[toxicity.subwords("insult")] = 1.0
    values = toxicity.Values(buckets)
    found = [toxicity.margin(" ".join(["so"] * k + ["insult"] * 4 + ["so"] * (40 - k)), values) for k in range(41)]
    base = values["so"] + (values["insult"] - values["so"]) * 4 / toxicity.STRETCH
    assert np.allclose(found, base)
    ending = toxicity.margin(" ".join(["so"] * 32 + ["insult"]), values)  # no stretch of one word
    assert np.isclose(ending, values["so"] + (values["insult"] - values["so"]) / toxicity.STRETCH)


def test_training_sees_the_stretches_that_are_scored(monkeypatch):
    texts = [" ".join(f"w{k * j % 7}" for k in range(n)) for j, n in enumerate((0, 1, 15, 16, 17, 50))]
    corpus = toxicity.Corpus(texts)
    buckets = np.random.default_rng(4).normal(size=toxicity.BUCKETS)
    margins = corpus.margins(buckets)
    assert np.bincount(corpus.text).tolist() == [1, 1, 1, 1, 2, 35]
    expected = [toxicity.margin(t, toxicity.Values(buckets)) for t in texts]
    assert np.allclose(margins[corpus.most(margins)], expected)


@pytest.mark.parametrize("operator", [nb_svm, toxicity])
def test_odd_documents(spark, operator):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 8)] + [(None, None, None)], LABELS)
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        found = operator.judge(docs, known, "toxic", 4, 2, 0.3).collect()
        assert len(found) == 10 and all(0 <= r.score <= 1 for r in found)
        assert {r["a.b"] for r in found} == {14}
        assert len({r.score for r in found if r.doc_id == 1}) == 1
    assert operator.judge(docs.limit(0), labels, "toxic", 4, 2, 0.3).count() == 0


def test_quality_reads_all_of_a_text_without_blanks(spark):
    draw = random.Random(3)
    rows, labels = [], []
    for k in range(300):
        body = "".join(chr(draw.randint(0x4E00, 0x4EFF)) for _ in range(640))
        rows.append((k, body if k % 2 else body[:320] + "#7" * 160))
        labels.append((k, k % 2, 0))
    a, b = "x" * 64 + "abc", "x" * 64 + "!9!"
    assert set(nb_svm.features(a, nb_svm.Codes())) != set(nb_svm.features(b, nb_svm.Codes()))
    assert nb_svm.shape(a) != nb_svm.shape(b)
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)
    held = nb_svm.judge(docs, known, "quality", 5, 0, 0.3).filter("held_out").join(known, "doc_id").collect()
    assert area([r.score for r in held], [r.quality for r in held]) > 0.95


def labelled_tables(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, y int")


def test_sample_is_bounded_in_rows_and_bytes(spark):
    from gradewell.llm import training

    rows = [(1, f"text number {k}") for k in range(3000)] + [(1, "the same text")] * 3000 + [(k, "x " * 10) for k in range(2, 60)]
    rows += [(60, "long " * 300_000)]
    docs, labels = labelled_tables(spark, rows, [(k, k % 2) for k in range(1, 61)])
    known = training.known_labels(labels, "y", "doc_id", 1_000_003, -5)
    found = training.sample(docs, known, 40, "doc_id", "text").toPandas()
    assert len(found) == 40 and found.y.sum() == 20
    assert not found.duplicated(["key", "text"]).any() and found.text.str.len().max() < 100
    again = training.sample(docs.repartition(7), known, 40, "doc_id", "text").toPandas()
    assert sorted(again.itertuples(index=False)) == sorted(found.itertuples(index=False))
    small = training.sample(docs, known, 200, "doc_id", "text", most_bytes=2000).toPandas()
    assert 0 < small.y.sum() < 100 and small.text.str.len().sum() <= 2000


def test_rare_words_are_learnt_from():
    from gradewell.llm import toxicity

    corpus = toxicity.Corpus(["once here", "twice here"])
    assert len(corpus.bag_sizes) == 3 and corpus.sizes.tolist() == [2, 2]


def test_ratios_against_plain_counts(spark):
    import math

    from gradewell.llm import nb_svm

    rows = [("good word here", 1), ("bad word here", 0), ("good good", 1), ("", 0)] * 3
    ratios, prior = nb_svm.log_count_ratios(spark.createDataFrame(rows, "text string, y int").repartition(3))
    assert prior == 0.5
    codes, counts = nb_svm.Codes(), [{}, {}]
    for text, y in rows:
        for bucket in nb_svm.features(text, codes).tolist():
            counts[y][bucket] = counts[y].get(bucket, 0) + 1
    totals = [nb_svm.BUCKETS + sum(c.values()) for c in counts]
    for bucket in counts[0].keys() | counts[1].keys():
        shares = [(1 + c.get(bucket, 0)) / n for c, n in zip(counts, totals)]
        assert math.isclose(ratios[bucket], math.log(shares[1] / shares[0]), rel_tol=1e-5, abs_tol=1e-6)
    assert (ratios != 0).sum() <= len(counts[0].keys() | counts[1].keys())


def test_documents_that_only_word_pairs_tell_apart():
    import numpy as np

    from gradewell.llm import nb_svm

    codes = nb_svm.Codes()
    one, other = (nb_svm.features(t, codes) for t in ("red box green bag", "green box red bag"))
    assert len(np.setxor1d(one, other)) > 0
