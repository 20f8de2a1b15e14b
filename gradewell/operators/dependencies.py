"""Functional dependencies: how far columns are determined by others.

A dependency is broken by the rows one would have to delete for it to hold: in each group of equal determinants all rows
but those of the most frequent value.  NULL is a value like any other.  Rows are counted by their values first, with
map-side combine, so copies of a record cost nothing after that, and a group is a set of counted values, never of rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Dependency = tuple[tuple[str, ...], str]
MEASURES = ("n_rows", "n_groups", "broken_groups", "rows_to_delete")


def title(dependency: Dependency) -> str:
    return f"{', '.join(dependency[0])} -> {dependency[1]}"


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def counted(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Different combinations of the columns with the number of their rows."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("n"))


def measure(counts: DataFrame, dependencies: Iterable[Dependency]) -> DataFrame:
    """One row per dependency over combinations counted as ``n``: rows, groups, groups with several values, rows to delete.

    A table without rows gives none.
    """
    asked = [
        F.struct(
            F.lit(title(d)).alias("dependency"), F.array(*map(_text, d[0])).alias("determinant"), _text(d[1]).alias("value")
        )
        for d in dependencies
    ]
    values = counts.select("n", F.explode(F.array(*asked)).alias("d")).groupBy("d").agg(F.sum("n").alias("n"))
    groups = values.groupBy("d.dependency", "d.determinant").agg(
        F.sum("n").alias("rows"), F.max("n").alias("kept"), F.count("*").alias("n_values")
    )
    return groups.groupBy("dependency").agg(
        F.sum("rows").alias("n_rows"),
        F.count("*").alias("n_groups"),
        F.count_if(F.col("n_values") > 1).alias("broken_groups"),
        F.sum(F.col("rows") - F.col("kept")).alias("rows_to_delete"),
    )


def dependency_report(rows: DataFrame, dependencies: list[Dependency]) -> DataFrame:
    """Declared dependencies with their measures and the share of rows against them."""
    columns = dict.fromkeys(c for d in dependencies for c in (*d[0], d[1]))
    found = measure(counted(rows, columns), dependencies)
    return found.withColumn("violation", F.col("rows_to_delete") / F.col("n_rows"))


def dependency_search(rows: DataFrame, columns: list[str], most: int = 2, tolerance: float = 0.0) -> DataFrame:
    """Smallest determinants of at most ``most`` columns: dependencies against which at most a ``tolerance`` of rows speak.

    Level by level: a determinant is tried only if none of its parts determines the column already.  Each level is one
    pass over the counted combinations; only names of dependencies come to the driver, as many as columns allow.
    """
    counts = counted(rows, columns)
    known: set[Dependency] = set()
    levels: list[DataFrame] = []
    for size in range(1, most + 1):
        asked = [
            (determinant, value)
            for determinant in combinations(columns, size)
            for value in columns
            if value not in determinant
            and not any((part, value) in known for k in range(1, size) for part in combinations(determinant, k))
        ]
        if not asked:
            break
        holds = measure(counts, asked).filter(F.col("rows_to_delete") <= tolerance * F.col("n_rows"))
        levels.append(holds.withColumn("n_determinants", F.lit(size)))
        if size < most:
            names = {r.dependency for r in holds.select("dependency").collect()}
            known |= {d for d in asked if title(d) in names}
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found
