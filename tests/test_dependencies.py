"""Functional dependencies against brute force on random rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from gradewell.operators import dependencies as dep

COLUMNS = ["a", "b b", "c.d", "e"]


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        a, b = rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None])
        rows.append((a, b, (a or 0) * 2 if rng.random() < 0.97 or seed % 2 else 9, f"{a}{b}"))
    return rows


def brute_force(rows, determinant, value):
    groups = defaultdict(Counter)
    for row in rows:
        groups[tuple(row[COLUMNS.index(c)] for c in determinant)][row[COLUMNS.index(value)]] += 1
    left = sum(sum(g.values()) - max(g.values()) for g in groups.values())
    return len(rows), len(groups), sum(len(g) > 1 for g in groups.values()), left


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    frame = spark.createDataFrame(rows, "a int, `b b` string, `c.d` int, e string")
    every = [(x, v) for n in (1, 2) for x in combinations(COLUMNS, n) for v in COLUMNS if v not in x]
    found = {r.dependency: tuple(r)[1:5] for r in dep.dependency_report(frame, every).collect()}
    assert found == {dep.title(d): brute_force(rows, *d) for d in every}
    for tolerance in (0.0, 0.05):
        holds = {d for d in every if brute_force(rows, *d)[3] <= tolerance * len(rows)}
        smallest = {dep.title(d) for d in holds if not any(((c,), d[1]) in holds for c in d[0] if len(d[0]) > 1)}
        searched = dep.dependency_search(frame, COLUMNS, tolerance=tolerance).collect()
        assert {r.dependency for r in searched} == smallest and len(searched) == len(smallest)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert dep.dependency_report(empty, [(("a",), "b")]).count() == 0
    assert dep.dependency_search(empty, ["a", "b"]).count() == 0
