from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from helpers import CLASHING
from pyspark.sql import functions as F

from gradewell.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>"


def matrices():
    draw = np.random.default_rng(3)
    for size in (1, 2, 5, 17, 40):
        m = draw.standard_normal((size, size))
        yield m + m.T
        yield m @ m.T
    yield np.zeros((4, 4))
    yield np.eye(6)
    yield np.array([[0.0, 1.0], [1.0, 0.0]])
    hollow = draw.standard_normal((12, 12))
    hollow = hollow + hollow.T
    np.fill_diagonal(hollow, 0.0)
    yield hollow


def test_pivots_count_eigenvalues():
    draw = np.random.default_rng(4)
    for matrix in matrices():
        values = np.linalg.eigvalsh(matrix)
        for shift in draw.uniform(values[0] - 1, values[-1] + 1, 25):
            if np.abs(values - shift).min() > 1e-9:
                assert w.count_above(matrix, shift) == (values > shift).sum()


@pytest.mark.parametrize("kind", ["random", "near", "equal", "low rank", "one", "graded", "pairs"])
def test_leading_eigenpairs(kind):
    draw = np.random.default_rng(9)
    turn = np.linalg.qr(draw.standard_normal((30, 30)))[0]
    values = {
        "random": draw.uniform(0.1, 9, 30), "near": 1 + 1e-7 * np.arange(30), "equal": np.ones(30), "low rank": np.r_[3.0, 2.0, 1.0, np.zeros(27)],
        "one": np.r_[5.0, np.zeros(29)], "graded": 10.0 ** -np.arange(0, 15, 0.5), "pairs": np.repeat(np.arange(1.0, 16.0), 2),
    }[kind]
    values = np.sort(values)[::-1]
    matrix = turn @ np.diag(values) @ turn.T
    found, vectors = w.Spectrum(matrix).leading(8)
    there = {"low rank": 3, "one": 1}.get(kind, 8)
    assert len(found) == there
    assert np.allclose(found, values[:there], rtol=1e-9, atol=1e-13 * values.sum())
    assert (np.diff(found) <= 1e-12 * values.sum()).all()
    assert np.abs(vectors.T @ vectors - np.eye(there)).max() < 1e-6
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * values.sum()


def plain(rows, components):
    """Everything in exact numbers, but for the eigenvectors."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, size = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(size)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = [[Fraction(n * a - s, n) for a, s in zip(r, sums)] for r in x]
    v = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    projected = np.array([[float(c) for c in r] for r in centred]) @ vectors / np.sqrt(values)
    return [k for k, _ in kept], deviation, projected, values / np.trace(v)


def test_against_exact_numbers(spark):
    draw = np.random.default_rng(6)
    rows = [(k, (draw.standard_normal(10) * np.arange(1, 11) + 3).astype(np.float32).tolist()) for k in range(60)]
    rows += rows[:5]  # repeated rows count
    rows += [(900, None), (901, [1.0, None, *[0.0] * 8]), (902, [math.nan, *[0.0] * 9]), (903, [-math.inf, *[0.0] * 9]), (None, [0.5] * 10)]
    found = w.whiten(spark.createDataFrame(rows, SCHEMA).repartition(7), "embedding", 8).collect()
    keys, deviation, projected, explained = plain(rows, 8)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in found) == sorted(zip([k if k is not None else -1 for k in keys], deviation))
    by_key = {r.vec_id: r for r in found}
    for key, row in zip(keys, projected):
        assert np.allclose(np.abs(by_key[key].whitened), np.abs(row), atol=1e-9)
    signs = np.sign(np.array([by_key[k].whitened for k in keys]) * projected)
    assert (np.abs(signs.sum(axis=0)) >= len(keys) - 1).all()  # one sign a component
    assert np.allclose(found[0].explained, explained, rtol=1e-10)
    assert {r.n for r in found} == {66} and {r.identity_error for r in found}.pop() < 1e-10


def test_odd_tables(spark):
    def run(rows):
        return w.whiten(spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(v).alias(k) for k, v in CLASHING.items())))

    assert run([]).count() == 0 and run([(1, None), (2, [])]).count() == 0
    same = run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).collect()
    assert [(r.deviation, r.whitened, r.n, r["a.b"]) for r in same] == [(0, [], 2, 14)] * 2
    mixed = run([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [5.0, 4.0]), (4, [1.0]), (5, [1.0, 1.0, 1.0])]).collect()
    assert sorted(r.vec_id for r in mixed) == [1, 2, 3] and {len(r.whitened) for r in mixed} == {2}
    huge = run([(1, [4e12, 0.0]), (2, [-4e12, 1.0]), (3, [9e30, 1.0])]).collect()
    assert [(r.vec_id, r.deviation) for r in huge] == [(1, None), (2, None)]
    assert all(np.isfinite(r.whitened).all() for r in huge)


def test_query_has_one_row_a_component(spark, small_folder):
    from gradewell.llm.queries import QUERIES

    found = QUERIES["op11_whitening"](spark, small_folder).toPandas()
    n = spark.read.parquet(f"{small_folder}/embeddings.parquet").count()
    assert len(found) == 8 * n and set(found.component) == set(range(1, 9))
    wide = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(8)).max() < 1e-9
    assert found.groupby("component").explained.first().is_monotonic_decreasing
