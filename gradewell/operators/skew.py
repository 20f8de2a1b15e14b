"""Joins and running counts that survive one key holding a large share of all rows.

A key counts as hot when its rows exceed both ``rows_per_task`` and the total
divided by ``MAX_HOT_KEYS``.  The shares of all keys add up to one, so fewer
than ``MAX_HOT_KEYS`` keys can be hot at any data size: the hot list may always
be broadcast, and spreading hot keys over their splits adds fewer than
``2 * MAX_HOT_KEYS`` lookup rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_HOT_KEYS = 65_536
ROWS_PER_TASK = 500_000
#: Rows of a lookup up to which a join is left to Spark's own choice.
LOOKUP_ROWS = 1_000_000


def hot_keys(counted: DataFrame, keys: list[str], total: Column, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hot keys of ``counted`` (one row per key with ``n_rows``) and their number of splits."""
    limit = F.greatest(total / F.lit(MAX_HOT_KEYS), F.lit(float(rows_per_task)))
    return counted.filter(F.col("n_rows") > limit).select(
        *keys, F.ceil(F.col("n_rows") / limit).cast("int").alias("splits")
    )


def hot_groups(
    rows: DataFrame, keys: list[str], hot_parents: DataFrame, parent: str, total: Column,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Hot groups of a finer key; each lies inside a hot parent, so only those rows are counted."""
    counted = (
        rows.select(*keys)
        .join(F.broadcast(hot_parents.select(parent)), parent, "left_semi")
        .groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
    )
    return hot_keys(counted, keys, total, rows_per_task)


def join_split(
    rows: DataFrame, lookup: DataFrame, keys: list[str], hot: DataFrame, spread_by: str, how: str = "inner"
) -> DataFrame:
    """Equi-join of many rows with a lookup unique on ``keys``, hot keys spread over several tasks.

    The lookup grows with the data, so the join is asked to sort and merge
    rather than to broadcast it on a size estimate.
    """
    split_rows = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_split", F.coalesce(F.expr(f"pmod(xxhash64({spread_by}), splits)").cast("int"), F.lit(0)))
        .drop("splits")
    )
    every_split = hot.select(*keys, F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("_split"))
    split_lookup = lookup.join(F.broadcast(every_split), keys, "left").fillna(0, ["_split"])
    return split_rows.join(split_lookup.hint("merge"), [*keys, "_split"], how).drop("_split")


def join_spread(
    rows: DataFrame, lookup: DataFrame, keys: list[str], hot: DataFrame, spread_by: str, how: str = "inner"
) -> DataFrame:
    """:func:`join_split` where there are hot keys, looked up now, else the plain merge join.

    Without the number of the split two sides that lie by the same key, or by a part of it, are not moved.
    """
    if hot.isEmpty():
        return rows.join(lookup.hint("merge"), keys, how)
    return join_split(rows, lookup, keys, hot, spread_by, how)


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: str, how: str = "left", lookup_rows: int = LOOKUP_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join with a lookup table that is small as a rule.

    Up to ``lookup_rows`` rows the join is left to Spark, which broadcasts by its own size check.  A larger lookup is
    sorted and merged, and keys that many rows share (counted here) are spread over several tasks.
    """
    if lookup.count() <= lookup_rows:
        return rows.join(lookup, keys, how)
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    hot = hot_keys(counted.dropna(subset=keys), keys, counted.agg(F.sum("n_rows")).scalar(), rows_per_task)
    return join_split(rows, lookup, keys, hot, spread_by, how)


#: Quantiles that cut a hot group into blocks; a block beyond them is cut evenly by id.
MAX_CUTS = 1024


def id_blocks(rows: DataFrame, cell: list[str], row_id: str, hot: DataFrame) -> DataFrame:
    """Id ranges of every hot cell, cut by the quantiles of its own ids: cell, first, lo, hi, width.

    ``splits`` blocks each, of about as many rows.  Beyond ``MAX_CUTS`` a range stands for several blocks of ``width``
    ids, the first of them numbered ``first``.  The number of ranges is bounded like the list of hot cells.
    """
    low, high = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    fractions = [k / MAX_CUTS for k in range(1, MAX_CUTS)]
    own = (
        rows.select(*cell, row_id)
        .join(F.broadcast(hot), cell)
        .groupBy(*cell)
        .agg(
            F.percentile_approx(row_id, fractions, 10 * MAX_CUTS).alias("q"),
            F.max("splits").alias("splits"), F.min(row_id).alias("least"), F.max(row_id).alias("most"),
        )
    )
    n = F.least(F.col("splits"), F.lit(MAX_CUTS))
    step = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.get("q", F.floor(k * MAX_CUTS / n).cast("int") - 1))
    cuts = F.array_distinct(F.when(n > 1, step).otherwise(F.array().cast("array<bigint>")))
    parts = F.ceil(F.col("splits") / MAX_CUTS)
    bounded = own.withColumn("cuts", cuts).withColumn("parts", parts)
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("cuts")),
        lambda k: F.struct(
            (k * F.col("parts")).alias("first"),
            F.coalesce(F.get("cuts", k - 1) + 1, low).alias("lo"),
            F.coalesce(F.get("cuts", k), high).alias("hi"),
            F.coalesce(F.get("cuts", k - 1) + 1, F.col("least")).alias("from_id"),
            F.coalesce(F.get("cuts", k), F.col("most")).alias("to_id"),
        ),
    )
    each = bounded.select(*cell, "parts", F.inline(ranges))
    width = F.ceil((F.col("to_id") - F.col("from_id") + 1) / F.col("parts"))
    return each.select(*cell, "first", "lo", "hi", "from_id", F.greatest(width, F.lit(1)).alias("width"))


#: Ranges of one branch of the search tree; a branch per ``BRANCH`` ranges.
BRANCH = 32


def search_tree(ranges: DataFrame, cell: list[str]) -> DataFrame:
    """The ranges of every cell (see :func:`id_blocks`) as one row: cell, ``branches`` of up to ``BRANCH`` ranges in order, and
    the least id of each in ``starts``."""
    sorted_ranges = F.sort_array(F.collect_list(F.struct("lo", "first", "from_id", "width")))
    branches = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_ranges") - 1) / BRANCH)), lambda k: F.slice("_ranges", (k * BRANCH + 1).cast("int"), BRANCH)
    )
    return (
        ranges.groupBy(*cell).agg(sorted_ranges.alias("_ranges"))
        .withColumn("branches", branches)
        .select(*cell, "branches", F.transform("branches", lambda b: b[0]["lo"]).alias("starts"))
    )


def range_of(row_id: Column, branches: Column, starts: Column) -> Column:
    """The range that holds an id: its branch, then its place there, at most ``2 * BRANCH`` comparisons for ``MAX_CUTS`` ranges."""
    branch = F.get(branches, F.size(F.filter(starts, lambda lo: lo <= row_id)) - 1)
    return F.get(branch, F.size(F.filter(branch, lambda r: r["lo"] <= row_id)) - 1)


def running_total(rows: DataFrame, keys: list[str], step: str, row_id: str, value: Column, name: str, hot: DataFrame) -> DataFrame:
    """Running sum of ``value`` per ``keys`` in the order (``step``, ``row_id``).

    ``step`` has a small domain and ``row_id`` is a unique bigint.  A group is summed in
    bounded windows: over its few steps, and over the rows of one step.  Steps
    listed in ``hot`` (keys, step and ``splits``) are cut into that many id
    ranges of about as many rows each (:func:`id_blocks`), whose sums carry over; the splits of
    all hot keys together are bounded, so ranges and sums may be broadcast.
    """
    cell = [*keys, step]
    block = [*cell, "_block"]
    zero = F.lit(0).cast("bigint")
    before = Window.unboundedPreceding, -1

    tree = search_tree(id_blocks(rows, cell, row_id, hot), cell)
    tree = tree.select(*(F.col(c).alias(f"_b_{c}") for c in cell), "branches", "starts")
    own = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in cell]
    found = F.when(F.col("starts").isNotNull(), range_of(F.col(row_id), F.col("branches"), F.col("starts")))
    number = F.col("_range.first") + F.floor((F.col(row_id) - F.col("_range.from_id")) / F.col("_range.width"))
    rows = (
        rows.withColumn("_value", value.cast("bigint"))
        .join(F.broadcast(tree), own, "left")
        .withColumn("_range", found)
        .withColumn("_hot", F.col("_range").isNotNull())
        .withColumn("_block", F.coalesce(number, zero))
        .drop(*tree.columns, "_range")
    )

    cell_sums = rows.groupBy(*cell).agg(F.sum("_value").alias("_sum"))
    steps = Window.partitionBy(*keys).orderBy(step).rowsBetween(*before)
    cell_start = cell_sums.select(*cell, F.coalesce(F.sum("_sum").over(steps), zero).alias("_cell_start"))

    block_sums = rows.filter("_hot").groupBy(*block).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*cell).orderBy("_block").rowsBetween(*before)
    block_start = block_sums.select(*block, F.coalesce(F.sum("_sum").over(earlier), zero).alias("_block_start"))

    start = cell_start.join(F.broadcast(block_start), cell, "left").select(
        *cell,
        F.coalesce("_block", zero).alias("_block"),
        (F.col("_cell_start") + F.coalesce("_block_start", zero)).alias("_start"),
    )
    within = Window.partitionBy(*block).orderBy(row_id).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(start.hint("merge"), block)
        .withColumn(name, F.sum("_value").over(within) + F.col("_start"))
        .drop("_value", "_block", "_start", "_hot")
    )
