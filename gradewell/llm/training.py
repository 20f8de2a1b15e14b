"""What the trained operators share: labelled rows, a bounded sample of them, fitting in one task, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.common import content_key, field, packed, scratch, stored

#: Labels (a key and a number each) up to this many are sent to every task; more are joined by sorting.
BROADCAST_ROWS = 500_000
#: Most bytes of all texts a model is fitted on in one task.
SAMPLE_BYTES = 64 << 20


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text, by which rows are held out; null keys are fold -1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(-1))


def known_labels(labels: DataFrame, label: str, key: str, folds: int, held_out: int) -> DataFrame:
    """key and y (0 or 1) of the labelled rows that are not held out; the labels of the others are dropped unread.

    Labels that are null, or neither 0 nor 1, are left out; of several labels of one key the largest counts.
    """
    seen = packed(labels).select(field(key).alias("key"), field(label).cast("int").alias("y"))
    seen = seen.filter(F.col("key").isNotNull() & (fold(F.col("key"), folds) != held_out) & F.col("y").isin(0, 1))
    return stored(seen.groupBy("key").agg(F.max("y").alias("y")), "labels")


def texts_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return packed(docs).select(field(key).alias("key"), F.coalesce(field(text), F.lit("")).alias("text"))


def labelled(docs: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and y of every document in ``known``; these are sent to every task while they are few."""
    return texts_of(docs, key, text).join(F.broadcast(known) if known.count() <= BROADCAST_ROWS else known, "key")


def sample(docs: DataFrame, known: DataFrame, most: int, key: str, text: str, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Up to ``most`` labelled texts, half of each class where there are enough, in a fixed pseudo-random choice.

    Rows of equal key and text are one example, so copies of an id take no more than their share.  Together the texts have at
    most ``most_bytes``; one of more than a 64th of that is not learnt from.  The rows are chosen without
    their texts; the list is bounded by ``most``, so it may be sent to every task.
    """
    of = ["key", "_h1", "_h2"]
    slim = labelled(docs, known, key, text).select("key", *content_key(F.col("text")), "y", F.octet_length("text").alias("size"))
    slim = stored(slim.filter(F.col("size") <= most_bytes // 64).distinct(), "sample-candidates")
    order = [F.xxhash64(*of), *of]
    halves = [slim.filter(F.col("y") == y).orderBy(*order).limit(most // 2) for y in (0, 1)]
    read = Window.partitionBy("y").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chosen = halves[0].unionByName(halves[1]).withColumn("read", F.sum("size").over(read)).filter(F.col("read") <= most_bytes // 2)
    chosen = stored(chosen.select(*of, "y"), "sample-keys")
    texts = texts_of(docs, key, text).select("key", *content_key(F.col("text")), "text")
    return texts.join(F.broadcast(chosen), of).groupBy(*of).agg(F.first("y").alias("y"), F.first("text").alias("text")).drop("_h1", "_h2")


def fit(rows: DataFrame, train: Callable[[pd.DataFrame], bytes]) -> bytes:
    """A model fitted on all of ``rows``, a bounded number, in one task; its bytes.

    The task's result is stored, so losing an executor repeats only the fit.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = list(batches)
        if given:
            whole = pd.concat(given, ignore_index=True).sort_values(["key", "text"], ignore_index=True)
            yield pd.DataFrame({"model": [train(whole)]})

    path = scratch(rows.sparkSession, "model")
    rows.repartition(1).mapInPandas(run, "model binary").write.parquet(path)
    found = rows.sparkSession.read.schema("model binary").parquet(path).collect()
    return bytes(found[0].model) if found else train(pd.DataFrame({c: [] for c in rows.columns}))


def calibrate(margins: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins and labels (Platt), for a share ``prior`` of label 1.

    Classes are weighted to that share and targets are smoothed, so separable margins keep a finite slope.
    """
    positive, negative = int(y.sum()), int(len(y) - y.sum())
    if not positive or not negative:
        share = min(max(prior, 0.01), 0.99)
        return 0.0, float(np.log(share / (1 - share)))
    scale = float(np.std(margins)) or 1.0
    x = margins / scale
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(y == 1, prior / positive, (1 - prior) / negative) * len(y)
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        error, curve = weight * (p - target), weight * p * (1 - p) + 1e-9
        gradient = np.array([error @ x, error.sum()])
        hessian = np.array([[curve @ (x * x), curve @ x], [curve @ x, curve.sum()]]) + np.eye(2) * 1e-6 * len(y)
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, float(np.abs(step).max()))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope / scale), float(shift)
