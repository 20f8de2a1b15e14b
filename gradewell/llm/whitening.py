"""Embedding whitening: leading eigenvectors of the covariance by spectrum slicing.

* **Integers.**  An entry c becomes ``floor(1024 c) + 100000``, so sums are exact, and so is every entry's distance
  from the mean as a multiple of 1/n.
* **Covariance.**  One pass adds up the vectors, a second one the products of their distances from the rounded mean;
  the rest of the mean is taken off exactly.  Every task sends one number a pair of dimensions, whatever it reads.
* **Spectrum slicing.**  The signs of the pivots of an LDL' factorisation of the covariance minus a shift count the
  eigenvalues above the shift (Sylvester).  Bisection by counts isolates each leading eigenvalue; Rayleigh quotient
  iteration then converges cubically.  Counts just below and just above the result certify its number.
  Eigenvalues too close to be told apart are iterated as one block.
* **Whitening.**  A row's distance from the mean, projected on a component, over the root of its eigenvalue.  The
  factorisations see only the covariance, whose size is that of one vector squared.

Results that are defined: a row is left out if its vector is null or has an entry that is null, not finite or of
``LIMIT`` and more in size; of several vector lengths the most frequent one counts (the shorter on a tie) and the others
are left out; repeated rows count as often as they are there; components whose eigenvalue is zero up to rounding do not
exist, so equal vectors and single ones give no component; an empty table gives an empty result; a deviation beyond a
long is null.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, packed, stored, unpacked

SCALE, SHIFT = 1024.0, 100_000
#: Entries from this size on are no embeddings; below it they are exact as integers.
LIMIT = float(1 << 42)
#: Most tasks that send partial sums, so that these stay bounded.
PARTIALS = 1024
#: Eigenvalues nearer than this share of the trace are iterated as one block.
CLUSTER = 1e-10
ROUNDS = 12


@dataclass(frozen=True)
class Model:
    """What is known of the fitted vectors: their number, sums by dimension, and the leading components."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


# --- the spectrum of a small symmetric matrix -------------------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: the positive ones of the pivots of an LDL' factorisation.

    Pivots of one or two rows are chosen so that no factor grows (Bunch and Kaufman); a pivot of two rows has one
    eigenvalue of either sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    bar, k, above = (1 + math.sqrt(17)) / 8, 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < len(a):
        below = np.abs(a[k + 1 :, k])
        largest, own, double = float(below.max(initial=0.0)), abs(float(a[k, k])), False
        if own == largest == 0.0:  # the shift itself is an eigenvalue
            k += 1
            continue
        if own < bar * largest:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            widest = float(row.max())
            if own * widest < bar * largest**2:
                double = abs(float(a[r, r])) < bar * widest
                swap(k + double, r)
        if double:
            side, block = a[k + 2 :, k : k + 2].copy(), a[k : k + 2, k : k + 2]
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
            above, k = above + 1, k + 2
        else:
            side = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(side / a[k, k], side)
            above, k = above + (a[k, k] > 0), k + 1
    return int(above)


class Spectrum:
    """The leading eigenpairs of a covariance matrix; shifts and their counts are remembered."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = (matrix + matrix.T) / 2
        self.size = len(matrix)
        self.trace = float(np.trace(matrix))
        self.tolerance = 8 * self.size * np.finfo(float).eps * self.trace
        self.counts = {-self.tolerance: self.size, self.trace + self.tolerance: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.matrix, shift)
        return self.counts[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """The nearest remembered shifts with at least ``number`` eigenvalues above the one and fewer above the other."""
        low = max(s for s, n in self.counts.items() if n >= number)
        return low, min(s for s, n in self.counts.items() if n < number and s > low)

    def start(self, found: list[np.ndarray], columns: int) -> np.ndarray:
        """Fixed pseudo-random directions without what is found already."""
        block = np.random.default_rng(len(found)).standard_normal((self.size, columns))
        for vector in found:
            block -= np.outer(vector, vector @ block)
        return np.linalg.qr(block)[0]

    def _solve(self, shift: float, right: np.ndarray) -> np.ndarray:
        try:
            solved = np.linalg.solve(self.matrix - shift * np.eye(self.size), right)
        except np.linalg.LinAlgError:  # the shift is the eigenvalue itself: step aside
            solved = np.linalg.solve(self.matrix - (shift + self.tolerance) * np.eye(self.size), right)
        return np.linalg.qr(solved)[0]

    def rayleigh(self, number: int, low: float, high: float, found: list[np.ndarray]) -> tuple[float, np.ndarray] | None:
        """The one eigenpair between two shifts; None if the iteration left them or its number is not certified."""
        vector = self._solve((low + high) / 2, self.start(found, 1))
        value, near = (low + high) / 2, False
        for _ in range(ROUNDS):
            image = self.matrix @ vector
            value = float((vector.T @ image).item())
            if near:  # the last step has taken all digits there are
                break
            near = float(np.linalg.norm(image - value * vector)) <= self.tolerance
            vector = self._solve(value, vector)
        inside = low <= value <= high and np.linalg.norm(self.matrix @ vector - value * vector) <= 4 * self.tolerance
        certified = inside and self.above(value - 4 * self.tolerance) >= number > self.above(value + 4 * self.tolerance)
        return (value, vector[:, 0]) if certified else None

    def block(self, low: float, high: float, found: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """All eigenpairs between two shifts that are too near to be told apart."""
        block = self.start(found, self.above(low) - self.above(high))
        for _ in range(ROUNDS):
            block = self._solve((low + high) / 2, block)
        values, turn = np.linalg.eigh(block.T @ self.matrix @ block)
        block = block @ turn
        return [(float(values[k]), block[:, k]) for k in reversed(range(len(values)))]

    def leading(self, components: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``components`` eigenvalues above rounding, falling, and their unit vectors as columns."""
        values, vectors = [], []
        while len(values) < min(components, self.size):
            number = len(values) + 1
            if self.above(4 * self.tolerance) < number:
                break
            low, high = self.bracket(number)
            pair = None
            if high - low <= CLUSTER * self.trace:
                pairs = self.block(low, high, vectors)[number - 1 - self.above(high) :]
            else:
                if self.above(low) - self.above(high) == 1:
                    pair = self.rayleigh(number, low, high, vectors)
                if pair is None:
                    self.above((low + high) / 2)
                    continue
                pairs = [pair]
            values += [p[0] for p in pairs]
            vectors += [p[1] for p in pairs]
        kept = min(components, len(values))
        return np.array(values[:kept]), np.array(vectors[:kept]).reshape(kept, self.size).T


# --- sums over all rows -------------------------------------------------------------------------------------


def integers(vector: Column) -> Column:
    """The vector as longs; null where it is null or has an entry that is null, not finite or too large."""
    double = F.transform(vector, lambda c: c.cast("double"))
    usable = F.forall(double, lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False)))
    whole = F.transform(double, lambda c: (F.floor(c * SCALE) + SHIFT).cast("bigint"))
    return F.when(F.coalesce(usable, F.lit(False)), whole)


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(x: DataFrame, size: int) -> list[int]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += _matrix(batch, size).sum(axis=0)
        yield pa.record_batch({"place": np.arange(size), "total": total})

    sums = x.mapInArrow(add, "place bigint, total bigint").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return [int(r.total) for r in sums.orderBy("place").collect()]


def _products(x: DataFrame, size: int, centre: np.ndarray) -> np.ndarray:
    """Sums of products of distances from ``centre``; exact below 2**53."""
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            distance = (_matrix(batch, size) - centre).astype(np.float64)
            total += distance.T @ distance
        yield pa.record_batch({"place": np.arange(len(upper[0])), "total": total[upper]})

    sums = x.mapInArrow(add, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).toPandas()
    result = np.zeros((size, size))
    places = sums["place"].to_numpy()
    result[upper[0][places], upper[1][places]] = sums["total"].to_numpy()
    return result + np.triu(result, 1).T


def _few_tasks(x: DataFrame) -> DataFrame:
    return x.coalesce(PARTIALS)


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = 8) -> Model:
    """The leading components of the covariance of all usable vectors."""
    x = packed(embeddings).select(integers(field(vector)).alias("x")).filter("x IS NOT NULL AND size(x) > 0")
    lengths = x.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not lengths:
        return Model(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    size, n = lengths[0]["size"], lengths[0]["count"]
    x = _few_tasks(x.filter(F.size("x") == size))
    sums = _sums(x, size)
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the rounded mean
    rest = np.array([(s - n * c) / n for s, c in zip(sums, centre)])
    covariance = _products(x, size, np.array(centre, np.int64)) / n - np.outer(rest, rest)
    spectrum = Spectrum(covariance)
    values, vectors = spectrum.leading(components) if spectrum.trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    return Model(n, tuple(sums), spectrum.trace, values, vectors)


# --- whitened rows ------------------------------------------------------------------------------------------


def deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2 of every row, exact."""
    n, sums = model.n, model.sums
    size = n * (int(np.abs(x).max(initial=0)) + 1) + max((abs(s) for s in sums), default=0)
    if size < 1 << 62:
        distance = n * x - np.array(sums, np.int64)
        if int(np.abs(distance).max(initial=0)) ** 2 * max(len(sums), 1) < 1 << 63:
            return (distance * distance).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [d if d < 1 << 63 else None for d in exact]


def transform(embeddings: DataFrame, model: Model, vector: str = "embedding") -> DataFrame:
    """The input columns of the usable rows, ``deviation`` and ``whitened`` (one number a component)."""
    size = len(model.sums)
    project = model.vectors / np.sqrt(model.values) if model.n else np.zeros((0, 0))
    mean_floor = np.array([s // model.n for s in model.sums], np.int64) if model.n else np.zeros(0, np.int64)
    mean_rest = np.array([s % model.n / model.n for s in model.sums]) if model.n else np.zeros(0)

    @F.pandas_udf("deviation bigint, whitened array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = np.stack(rows.to_list()) if len(rows) else np.zeros((0, size), np.int64)
            whitened = ((x - mean_floor) - mean_rest) @ project
            yield pd.DataFrame({"deviation": pd.array(deviations(x, model), "Int64"), "whitened": list(whitened)})

    rows = packed(embeddings).withColumn("_x", integers(field(vector))).filter(F.size("_x") == (size or -1))
    found = rows.withColumn("_of", of("_x")).withColumns({"deviation": F.col("_of.deviation"), "whitened": F.col("_of.whitened")})
    return unpacked(found, "deviation", "whitened")


def identity_error(whitened: DataFrame, components: int, column: str = "whitened") -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity; 0 without components."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    w = [F.get(column, F.lit(k)) for k in range(components)]
    if not pairs:
        return 0.0
    means = whitened.agg(*(F.avg(c) for c in w)).first()
    if means[0] is None:
        return 0.0
    centred = [c - F.lit(m) for c, m in zip(w, means)]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """The input columns of the usable rows with n, deviation, whitened, explained (arrays, one entry a component) and identity_error."""
    model = fit(embeddings, vector, components)
    rows = stored(transform(embeddings, model, vector), "whitened")
    error = identity_error(rows, len(model.values))
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    added = {"n": F.lit(model.n).cast("bigint"), "explained": explained, "identity_error": F.lit(error)}
    return unpacked(packed(rows).withColumns({k: v for k, v in added.items()}), *added)
