"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

* **Words** are lower-cased, without punctuation at their ends.  A word is the bag of its character n-grams, marked
  at both ends, and of itself, hashed into ``BUCKETS`` vectors; its vector is their mean, so a misspelling never
  seen shares most vectors with the word it comes from.
* **Softmax.**  The mean vector of a stretch of ``STRETCH`` words goes through a linear layer into two classes.  Stretches
  start at every word, and a text shorter than one is a stretch.  A text gets the score of its most toxic stretch, so
  that a few words are found in a text of any length and at any place.
* **Training.**  Vectors and layer are trained together on a bounded sample of labelled rows that are not held out, in
  one task: first every stretch takes the label of its text, then only the most toxic one of each text does.  A
  part of the sample is left out; its margins calibrate the score to the share of label 1 among all labelled rows.
* **Scores.**  As averages are linear, a word adds a fixed number to its stretch; tasks remember the numbers of words.

Key, language and source are never features.  Results that are defined: a null or empty text, or one without words, is
one empty stretch and gets the score of the bias; without labels, or with one class only, every document gets the
share of label 1 (0.5 without labels); repeated rows are scored alike; an empty table gives an empty result.  Input
columns named like a result column give way to it.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, packed, unpacked
from gradewell.llm.training import calibrate, fit, fold, known_labels, sample

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (3, 4, 5)
STRETCH = 16
#: Most labelled rows the model is trained on.
SAMPLE_ROWS = 4_000
#: Rounds in which all stretches take the text's label, and in which only the most toxic one does.
ROUNDS = (4, 50)
#: Added to curvatures, relative to the largest.
RIDGE = 3e-4
RATE, MOMENTUM, LAYER_RATE, BIAS_RATE = 0.5, 0.8, 0.1, 0.5
#: Words a task remembers.
MEMORY = 400_000
#: Punctuation that is cut from the ends of words.
EDGES = ".,;:!?*#$%&|<>()[]{}\"'`-_/\\~^+=@"


def words(text: str) -> list[str]:
    return [w for w in (v.strip(EDGES) for v in text.lower().split()) if w]


def subwords(word: str) -> np.ndarray:
    """Buckets of a word's n-grams and of the word itself."""
    marked = f"<{word}>"
    grams = {marked}
    for n in GRAMS:
        grams.update(marked[k : k + n] for k in range(len(marked) - n + 1))
    return np.fromiter((zlib.crc32(g.encode()) % BUCKETS for g in grams), np.int64, len(grams))


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2 ... values."""
    return np.concatenate([[0.0], np.cumsum(values)])


def _spread(starts: np.ndarray, ends: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` places the sum of the values of the stretches it is in."""
    return np.cumsum(np.bincount(starts, values, n + 1) - np.bincount(ends, values, n + 1))[:n]


class Corpus:
    """Texts of a sample as numbers: words of every text, subwords of every distinct word, stretches of every text."""

    def __init__(self, texts: list[str]) -> None:
        read = [words(t) for t in texts]
        numbers: dict[str, int] = {}
        each = [[numbers.setdefault(w, len(numbers)) for w in found] for found in read]
        bags = [subwords(w) for w in numbers]
        self.bag_sizes = np.array([len(b) for b in bags], np.int64)
        self.bags = np.concatenate(bags) if bags else np.empty(0, np.int64)
        self.bag_starts = _starts(self.bag_sizes)
        self.words = np.array([w for ids in each for w in ids], np.int64)
        lengths = np.array([len(ids) for ids in each], np.int64)
        counts = np.maximum(lengths - STRETCH, 0) + 1
        self.text_starts = _starts(counts)
        self.text = np.repeat(np.arange(len(each)), counts)
        self.sizes = np.minimum(lengths, STRETCH)[self.text]
        self.starts = np.arange(counts.sum()) + (_starts(lengths) - self.text_starts)[self.text]

    def word_values(self, buckets: np.ndarray) -> np.ndarray:
        """Number of every distinct word: the mean over its bag."""
        sums = np.add.reduceat(buckets[self.bags], self.bag_starts) if len(self.bags) else np.empty(0)
        return sums / self.bag_sizes

    def margins(self, buckets: np.ndarray) -> np.ndarray:
        """Mean over the words of every stretch."""
        total = _running(self.word_values(buckets)[self.words])
        return (total[self.starts + self.sizes] - total[self.starts]) / np.maximum(self.sizes, 1)

    def most(self, margins: np.ndarray) -> np.ndarray:
        """The stretch with the largest margin of every text."""
        largest = np.flatnonzero(margins == np.maximum.reduceat(margins, self.text_starts)[self.text])
        return largest[np.unique(self.text[largest], return_index=True)[1]]


def learn(corpus: Corpus, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket vectors, layer (dimensions x 2) and bias (2) of the softmax; both classes weigh the same.

    Gradient steps with momentum.  A bucket's step is divided by its curvature, so that n-grams of a few frequent short
    words do not outrun those of rare long ones; then all are scaled so that the one that moves most moves by ``RATE``.
    """
    draw = np.random.default_rng(5)
    vectors = draw.normal(0, 0.05, (BUCKETS, DIMENSIONS))
    layer = draw.normal(0, 1, (DIMENSIONS, 2))
    layer /= np.linalg.norm(layer, axis=0)
    bias, moved = np.zeros(2), np.zeros_like(vectors)
    text_weight = (0.5 / np.bincount(y, minlength=2))[y]
    stretches = np.bincount(corpus.text)
    curved = curvature(corpus, (text_weight / stretches)[corpus.text])
    divisor = (curved / max(float(curved.max()), 1e-12) + RIDGE)[:, None]
    for step in range(sum(ROUNDS)):
        if step < ROUNDS[0]:
            chosen = np.arange(len(corpus.sizes))
            weight = (text_weight / stretches)[corpus.text]
        else:
            chosen = corpus.most(corpus.margins(vectors @ (layer[:, 1] - layer[:, 0])))
            weight = text_weight
        of_vectors, of_layer, of_bias = gradients(corpus, chosen, y[corpus.text[chosen]], weight, vectors, layer, bias)
        of_vectors = of_vectors / divisor
        largest = float(np.linalg.norm(of_vectors, axis=1).max())
        moved = MOMENTUM * moved + of_vectors * (RATE / max(largest, 1e-12))
        vectors -= moved
        layer -= LAYER_RATE * of_layer
        bias -= BIAS_RATE * of_bias
    used = np.zeros(BUCKETS, bool)
    used[corpus.bags] = True
    vectors[~used] = 0.0  # never trained
    return vectors, layer, bias


def curvature(corpus: Corpus, weight: np.ndarray) -> np.ndarray:
    """Weighted sum of squares of what each bucket contributes to the mean of a stretch."""
    each = weight / np.maximum(corpus.sizes, 1) ** 2
    at_place = np.maximum(_spread(corpus.starts, corpus.starts + corpus.sizes, each, len(corpus.words)), 0.0)
    of_words = np.bincount(corpus.words, at_place, len(corpus.bag_sizes))
    of_word = np.repeat(np.arange(len(corpus.bag_sizes)), corpus.bag_sizes)
    return np.bincount(corpus.bags, (of_words / corpus.bag_sizes**2)[of_word], BUCKETS)


def gradients(
    corpus: Corpus, chosen: np.ndarray, y: np.ndarray, weight: np.ndarray, vectors: np.ndarray, layer: np.ndarray,
    bias: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the weighted softmax loss of the chosen stretches: bucket vectors, layer, bias."""
    sizes, n = corpus.sizes[chosen], len(corpus.words)
    starts, ends = corpus.starts[chosen], corpus.starts[chosen] + sizes
    covered = np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] > 0
    rank = np.concatenate([[0], np.cumsum(covered)])
    starts, ends, at = rank[starts], rank[ends], np.flatnonzero(covered)  # among the words of chosen stretches
    word, place = np.unique(corpus.words[at], return_inverse=True)
    bag_sizes = corpus.bag_sizes[word]
    of_word = np.repeat(np.arange(len(word)), bag_sizes)
    bags = corpus.bags[np.repeat(corpus.bag_starts[word] - _starts(bag_sizes), bag_sizes) + np.arange(bag_sizes.sum())]

    word_vectors = _sums(of_word, vectors[bags], len(word)) / bag_sizes[:, None]
    running = (_running(word_vectors[place, d]) for d in range(vectors.shape[1]))
    means = np.stack([total[ends] - total[starts] for total in running], axis=1) / np.maximum(sizes, 1)[:, None]
    logits = means @ layer + bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    error = p / p.sum(axis=1, keepdims=True)
    error[np.arange(len(y)), y] -= 1
    error *= weight[:, None]

    back = (error @ layer.T) / np.maximum(sizes, 1)[:, None]
    spread = (_spread(starts, ends, back[:, d], len(at)) for d in range(back.shape[1]))
    back_words = np.stack([np.bincount(place, one, len(word)) for one in spread], axis=1) / bag_sizes[:, None]
    return _sums(bags, back_words[of_word], BUCKETS), means.T @ error, error.sum(axis=0)


def _sums(group: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by group."""
    return np.stack([np.bincount(group, rows[:, d], n) for d in range(rows.shape[1])], axis=1)


@dataclass(frozen=True)
class Model:
    """What a bucket adds to a margin, the bias, and the curve from margin (its inverse hyperbolic sine) to score."""

    buckets: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(margins) + self.shift, -30, 30)))


class Values(dict):
    """Word to the number it adds, remembered up to a bound."""

    def __init__(self, buckets: np.ndarray) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = float(self.buckets[subwords(word)].mean())
        return value


def margin(text: str, values: Values) -> float:
    """Margin of the most toxic stretch, without the bias."""
    found = words(text)
    if not found:
        return 0.0
    total = _running(np.fromiter(map(values.__getitem__, found), np.float64, len(found)))
    size = min(STRETCH, len(found))
    return float((total[size:] - total[:-size]).max()) / size


def _fit(given: pd.DataFrame, prior: float) -> bytes:
    texts, y = given["text"].tolist(), given["y"].to_numpy(np.int64)
    if len(set(y.tolist())) < 2:
        slope, shift = calibrate(np.zeros(len(y)), y, prior)
        return pickle.dumps((np.zeros(BUCKETS, np.float32), 0.0, slope, shift))

    order = np.random.default_rng(11).permutation(len(texts))
    left_out, rest = np.split(order, [len(order) // 7])
    vectors, layer, bias = learn(Corpus([texts[k] for k in rest]), y[rest])
    buckets = (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    values, shared = Values(buckets), float(bias[1] - bias[0])
    margins = np.array([margin(texts[k], values) + shared for k in left_out])
    return pickle.dumps((buckets, shared, *calibrate(np.arcsinh(margins), y[left_out], prior)))


def train(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, key: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of ``label`` from the labelled documents whose CRC-32 fold is not ``held_out``."""
    known = known_labels(labels, label, key, folds, held_out)
    prior = known.agg(F.avg("y")).first()[0]
    prior = 0.5 if prior is None else prior
    rows = sample(docs, known, sample_rows, key, text)
    return Model(*pickle.loads(fit(rows, lambda given: _fit(given, prior))))


def score(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The input columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score at least threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        values = Values(model.buckets)
        for texts in batches:
            yield pd.Series(model.score(np.array([margin(t, values) for t in texts]) + model.bias))

    scored = packed(docs).withColumn("score", scores(F.coalesce(field(text), F.lit(""))))
    return unpacked(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "score", "predicted")


def judge(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, threshold: float,
    key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The input columns, held_out (not learnt from), score and predicted, by a model trained on the labelled rows."""
    marked = packed(docs).withColumn("held_out", fold(field(key), folds) == held_out)
    model = train(docs, labels, label, folds, held_out, key, text, sample_rows)
    return score(unpacked(marked, "held_out"), model, threshold, text)
