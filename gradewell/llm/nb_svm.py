"""Quality classifier: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model.

* **Features.**  Lower-cased words and pairs of neighbouring words, word shapes ("ABC!!" is "X!") and pairs of neighbouring
  shapes, marked when both words are the same; hashed into ``BUCKETS`` indicators per document.  A word of more than ``PIECE`` characters, as in
  text without blanks, is read as its consecutive pieces, so that all of it gives features.
* **Naive Bayes.**  Documents with a feature are counted per class over *all* labelled rows that are not held out;
  a feature's scale is the log of the ratio of its smoothed shares.
* **Support vectors.**  On a bounded sample of these rows, half of each class, the scaled indicators are fitted
  with squared-norm regularised hinge loss by dual coordinate descent, in one task.  A fifth of the sample is left
  out of a first fit, and its margins calibrate the score to the share of label 1 among all labelled rows.
* **Scores** of all documents come from one table of weights of fixed size; a task reads texts batch by batch.

Key, language and source are never features.  Results that are defined: a null or empty text has no features and gets
the score of the bias alone; without labels, or with one class only, every document gets the share of label 1 (0.5
without labels); repeated rows are scored alike; an empty table gives an empty result.  Input columns named like a
result column give way to it.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, packed, unpacked
from gradewell.llm.training import calibrate, fit, fold, known_labels, labelled, sample

BUCKETS = 1 << 18
#: Most labelled rows the hinge-loss model is fitted on.
SAMPLE_ROWS = 6_000
COST = 0.1
#: Most characters of a word that is one feature.
PIECE = 64
EPOCHS = 20
#: Words a task remembers.
MEMORY = 400_000

_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """The word with upper-case letters as X, others as x, digits as 9, and every run as one character."""
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


class Codes(dict):
    """Word to one number: its bucket above 32 bits of its shape's hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        bucket = zlib.crc32(word.lower().encode()) % BUCKETS
        code = self[word] = bucket << 32 | zlib.crc32(b"shape " + shape(word).encode())
        return code


def features(text: str, codes: Codes) -> np.ndarray:
    """Buckets of a text's features, each once."""
    words = text.split()
    if max(map(len, words), default=0) > PIECE:
        words = [w[k : k + PIECE] for w in words for k in range(0, len(w), PIECE)]
    code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    shapes = (code & 0xFFFFFFFF).astype(np.uint64)
    same = (code[1:] == code[:-1]).astype(np.uint64)
    pairs = (shapes[:-1] * np.uint64(0x9E3779B1) + shapes[1:] * np.uint64(2) + same) * np.uint64(0xD6E8FEB86659FD93)
    single = shapes * np.uint64(0xD6E8FEB86659FD93)
    word = (code >> 32).astype(np.uint64)
    following = (word[:-1] * np.uint64(BUCKETS) + word[1:] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    top = np.uint64(64 - BUCKETS.bit_length() + 1)
    return np.unique(np.concatenate([code >> 32, *((f >> top).astype(np.int64) for f in (single, pairs, following))]))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class with each feature; bucket -1 counts all of them."""
    codes, counts, rows = Codes(), np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for text, y in zip(batch["text"], batch["y"]):
            counts[y, features(text, codes)] += 1
            rows[y] += 1
    found = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame(
        {"bucket": np.append(found, -1), "n0": np.append(counts[0, found], rows[0]), "n1": np.append(counts[1, found], rows[1])}
    )


def log_count_ratios(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Scale of every bucket, and the share of label 1; rows has text and y."""
    sums = (
        rows.select("text", "y").mapInPandas(_count, "bucket bigint, n0 bigint, n1 bigint")
        .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    )  # at most BUCKETS + 1 rows
    counts = np.ones((2, BUCKETS))
    known = sums[sums.bucket >= 0]
    counts[:, known.bucket.to_numpy(np.int64)] += np.stack([known.n0.to_numpy(), known.n1.to_numpy()])
    shares = counts / counts.sum(axis=1, keepdims=True)
    total = sums.loc[sums.bucket < 0, ["n0", "n1"]].sum()
    n = float(total.n0 + total.n1)
    ratios = np.log(shares[1] / shares[0])
    ratios[(counts == 1).all(axis=0)] = 0.0  # never seen
    return ratios.astype(np.float32), float(total.n1) / n if n else 0.5


def dual_coordinate_descent(
    rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over indicators times ``scale``; y is 0 or 1."""
    weights, bias = np.zeros(len(scale)), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    values = [scale[r].astype(np.float64) for r in rows]
    square = [float(v @ v) + 1.0 for v in values]
    alpha = np.zeros(len(rows))
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in draw.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                most = max(most, abs(step) * square[i])
        if most < 1e-3:
            break
    return weights, bias


@dataclass(frozen=True)
class Model:
    """Weight of every bucket (scale included), bias, and the curve from margin to score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum(dtype=np.float64)) + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _fit(given: pd.DataFrame, scale: np.ndarray, prior: float) -> bytes:
    codes = Codes()
    rows = [features(t, codes) for t in given["text"]]
    y = given["y"].to_numpy(np.int64)
    left_out = np.zeros(len(rows), bool)
    left_out[np.random.default_rng(11).permutation(len(rows))[: len(rows) // 5]] = True
    weights, bias = dual_coordinate_descent([r for r, o in zip(rows, left_out) if not o], scale, y[~left_out])
    first = Model(weights * scale, bias, 1.0, 0.0)
    margins = np.array([first.margin(r) for r, o in zip(rows, left_out) if o])
    slope, shift = calibrate(margins, y[left_out], prior)
    weights, bias = dual_coordinate_descent(rows, scale, y)
    return pickle.dumps(((weights * scale).astype(np.float32), bias, slope, shift))


def train(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, key: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of ``label`` from the labelled documents whose CRC-32 fold is not ``held_out``."""
    known = known_labels(labels, label, key, folds, held_out)
    scale, prior = log_count_ratios(labelled(docs, known, key, text))
    rows = sample(docs, known, sample_rows, key, text)
    return Model(*pickle.loads(fit(rows, lambda given: _fit(given, scale, prior))))


def _scores(docs: DataFrame, model: Model, text: str) -> Column:
    """Score of the text in a packed row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = Codes()
        for texts in batches:
            yield pd.Series(shared.value.score(np.array([shared.value.margin(features(t, codes)) for t in texts])))

    return scores(F.coalesce(field(text), F.lit("")))


def score(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The input columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score at least threshold)."""
    scored = packed(docs).withColumn("score", _scores(docs, model, text))
    return unpacked(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "score", "predicted")


def accepted(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The documents that score at least ``threshold``, with exactly their own columns."""
    return packed(docs).filter(_scores(docs, model, text) >= threshold).select("row.*")


def judge(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, threshold: float,
    key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The input columns, held_out (not learnt from), score and predicted, by a model trained on the labelled rows."""
    marked = packed(docs).withColumn("held_out", fold(field(key), folds) == held_out)
    model = train(docs, labels, label, folds, held_out, key, text, sample_rows)
    return score(unpacked(marked, "held_out"), model, threshold, text)
