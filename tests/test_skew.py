"""Split joins and running totals against their plain forms."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gradewell.operators.skew import MAX_HOT_KEYS, hot_groups, hot_keys, join_split, running_total


def skewed(spark, rows=4000):
    """A third of the rows belong to key 0."""
    return spark.range(rows).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.col("id") % 5).alias("step"),
    )


def counted(df):
    return df.groupBy("k").agg(F.count("*").alias("n_rows"))


def hot(df, rows_per_task):
    counts = counted(df)
    return hot_keys(counts, ["k"], counts.agg(F.sum("n_rows")).scalar(), rows_per_task)


def test_hot_keys_are_the_large_ones(spark):
    df = skewed(spark)
    assert [(r.k, r.splits) for r in hot(df, 200).collect()] == [(0, 7)]
    assert hot(df, 10_000).count() == 0


def test_number_of_hot_keys_is_bounded_by_the_share(spark):
    """With a tiny task size the share rule still limits the list."""
    counts = spark.range(200_000).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    assert hot_keys(counts, ["k"], total, 0).count() < MAX_HOT_KEYS


def test_split_join_equals_plain_join(spark):
    df = skewed(spark)
    lookup = counted(df).filter("k <> 3").withColumnRenamed("n_rows", "payload")
    for how in ("inner", "left"):
        found = join_split(df, lookup, ["k"], hot(df, 100), "row_id", how)
        expected = df.join(lookup, "k", how).select(*found.columns)
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_hot_key_is_spread_over_partitions(spark):
    df = skewed(spark, 30_000)
    lookup = counted(df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_split(df, lookup, ["k"], hot(df, 100), "row_id")
        parts = joined.filter("k = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(p["count"] for p in parts) < 5000


def test_hot_groups_lie_in_hot_parents(spark):
    df = skewed(spark)
    total = counted(df).agg(F.sum("n_rows")).scalar()
    groups = hot_groups(df, ["k", "step"], hot(df, 200), "k", total, 200)
    assert {(r.k, r.step) for r in groups.collect()} == {(0, s) for s in range(5)}


def test_blocks_follow_the_ids_of_their_own_step(spark):
    """A hot step whose ids lie together, with other ids far off, is still cut into blocks of like size."""
    from gradewell.operators.skew import id_blocks

    hot_rows = spark.range(30_000).select((F.col("id") + 500).alias("row_id"), F.lit(1).alias("k"), F.lit(0).alias("step"))
    rows = hot_rows.unionByName(spark.range(10).select((F.col("id") * 10**15).alias("row_id"), F.lit(1).alias("k"), F.lit(1).alias("step")))
    for splits in (1, 30, 3000):
        hot = spark.createDataFrame([(1, 0, splits)], "k int, step int, splits int")
        found = id_blocks(rows, ["k", "step"], "row_id", hot).collect()
        block = lambda i: next(r.first + (i - r.from_id) // r.width for r in found if r.lo <= i <= r.hi)  # noqa: E731,B023
        sizes = {}
        order = [block(i) for i in range(500, 30_500)]
        for b in order:
            sizes[b] = sizes.get(b, 0) + 1
        assert order == sorted(order) and max(sizes.values()) <= 2 * -(-30_000 // splits)


def hot_steps(df, rows_per_task):
    counts = df.groupBy("k", "step").agg(F.count("*").alias("n_rows"))
    return hot_keys(counts, ["k", "step"], counts.agg(F.sum("n_rows")).scalar(), rows_per_task)


@pytest.mark.parametrize("rows_per_task", [10, 40, 100_000])
@pytest.mark.parametrize("spread", [1, 10_000_000_000])
def test_running_total_equals_window(spark, rows_per_task, spread):
    """With every step, some steps and no step cut into id ranges."""
    df = skewed(spark).select((F.col("row_id") * spread).alias("row_id"), "k", "step", (F.col("row_id") % 2).alias("v"))
    hot_list = hot_steps(df, rows_per_task)
    found = running_total(df, ["k"], "step", "row_id", F.col("v"), "total", hot_list).select("row_id", "total")
    window = Window.partitionBy("k").orderBy("step", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("row_id", F.sum("v").over(window).alias("total"))
    assert found.count() == 4000
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_a_row_meets_few_ranges(spark):
    """The ranges of a hot cell lie in branches: one equality join, then a search in two steps."""
    from gradewell.operators.skew import BRANCH, MAX_CUTS, id_blocks, range_of, search_tree

    rows = spark.range(40_000).select((F.col("id") * 7 % 40_009).alias("row_id"), F.lit(1).alias("k"), F.lit(0).alias("step"))
    for splits in (1, 2, BRANCH, BRANCH + 1, MAX_CUTS, 5000):
        hot = spark.createDataFrame([(1, 0, splits)], "k int, step int, splits int")
        ranges = id_blocks(rows, ["k", "step"], "row_id", hot)
        tree = search_tree(ranges, ["k", "step"])
        (one,) = tree.collect()
        assert len(one.starts) == len(one.branches) <= BRANCH and max(map(len, one.branches)) <= BRANCH
        found = rows.join(tree, ["k", "step"]).select("row_id", range_of(F.col("row_id"), F.col("branches"), F.col("starts"))["lo"].alias("lo"))
        plain = rows.join(ranges, F.col("row_id").between(F.col("lo"), F.col("hi"))).select("row_id", "lo")
        assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


def test_ranges_are_met_by_equality_alone(spark):
    df = skewed(spark).select("row_id", "k", "step", (F.col("row_id") % 2).alias("v"))
    plan = running_total(df, ["k"], "step", "row_id", F.col("v"), "total", hot_steps(df, 40))._jdf.queryExecution().optimizedPlan().toString()
    assert "starts" in plan
    joins = [line.replace("<=>", "=") for line in plan.splitlines() if "Join" in line]
    assert joins and not any(sign in line for line in joins for sign in (">=", "<=", "<", ">"))
