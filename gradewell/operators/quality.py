"""Declarative data checks.

A single check returns what violates it.  :func:`report` runs a list of checks: those that look at one row at a
time are counted while their table is written (:func:`observed`) and cost no scan afterwards; keys that have to be
unique or to have a parent are grouped by their own type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once; a missing key is no duplicate."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def dq_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list and their number of rows; NULL passes."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n_rows"))


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Keys without a parent and their number of rows; NULL passes.

    Child rows are counted per key before the join, so a frequent key costs one row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def dq_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside the closed range; NULL passes."""
    return df.filter(~F.col(column).between(low, high))


def dq_single_credit_award(enriched: DataFrame) -> DataFrame:
    """Student and module pairs that were awarded credits more than once."""
    awards = enriched.groupBy("student_id", "module_number").agg(F.count_if(F.col("credits_earned") > 0).alias("awards"))
    return awards.filter(F.col("awards") > 1)


@dataclass(frozen=True)
class Checks:
    """The checks declared for one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    between: dict[str, tuple[float, float]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)

    def row_conditions(self) -> list[tuple[str, str, Column]]:
        """Column, check and violation condition of the row-local checks."""
        found = [(c, "not_null", F.col(c).isNull()) for c in self.not_null]
        found += [(c, "accepted_values", ~F.col(c).isin(*v)) for c, v in self.accepted.items()]
        found += [(c, "between", ~F.col(c).between(*r)) for c, r in self.between.items()]
        return found


#: Violations of the row checks of one table by (column, check).
Counts = dict[tuple[str, str], int]


def row_counts(checks: Checks) -> list[Column]:
    """One aggregate a row check: the rows that violate it."""
    return [F.count_if(violated).alias(f"{column} {check}") for column, check, violated in checks.row_conditions()]


def _by_check(row: dict) -> Counts:
    return {tuple(name.split(" ")): n for name, n in row.items()}


def observed(df: DataFrame, checks: Checks) -> tuple[DataFrame, Callable[[], Counts]]:
    """``df`` that counts the violations of its row checks when it is written, and what returns them afterwards.

    The counts are accumulated by the tasks that write, so they cost no pass over the rows.
    """
    metrics = row_counts(checks)
    if not metrics:
        return df, dict
    observation = Observation()
    return df.observe(observation, *metrics), lambda: _by_check(observation.get)


def counted(df: DataFrame, checks: Checks) -> Counts:
    """The violations of all row checks of a table that was not observed, from one pass."""
    metrics = row_counts(checks)
    return _by_check(df.agg(*metrics).first().asDict()) if metrics else {}


def _key_checks(model: str, df: DataFrame, checks: Checks, table: Callable[[str], DataFrame]) -> list[DataFrame]:
    """One row for every check on keys: how many violate it."""
    found = [(c, "unique", dq_unique(df, c).agg(F.count("*").alias("violations"))) for c in checks.unique]
    for column, (parent, key) in checks.parents.items():
        orphans = dq_relationships(df, column, table(parent), key)
        found.append((column, "relationships", orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))))
    return [
        one.select(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(check).alias("check_name"), "violations")
        for c, check, one in found
    ]


def report(
    table: Callable[[str], DataFrame], declared: dict[str, Checks], counts: Callable[[str], Counts] | None = None
) -> DataFrame:
    """Violations per declared check (rows, or keys for the uniqueness check) and whether it passed.

    ``counts`` knows the violations of a table's row checks; without it they are counted now.
    """
    known, keys, session = [], [], None
    for model, checks in declared.items():
        df = table(model)
        session = df.sparkSession
        rows = counts(model) if counts else counted(df, checks)
        known += [(model, column, check, n) for (column, check), n in rows.items()]
        keys += _key_checks(model, df, checks, table)
    fixed = session.createDataFrame(known, "model string, column_name string, check_name string, violations bigint")
    found = reduce(DataFrame.unionByName, keys, fixed)
    return found.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))


def summary(found: DataFrame) -> DataFrame:
    """Totals of a report: checks, passed and failed."""
    return found.agg(
        F.count("*").alias("checks"), F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    )
