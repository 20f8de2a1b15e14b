"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Built from DataFrame functions only.

* **Water-filling.** Every source is given a share of all words by its weight.  A source may be repeated
  ``max_epochs`` times at most; what it cannot take is shared out again by weight, until no target is above its
  cap.  Sorted by cap over weight the clamped sources come first, so the fixed point of that loop is the largest
  level ``(rest of the words) / (rest of the weights)`` at or below the next source's own ratio, and running sums
  over the table of sources find it in one step.
* **Repetitions.**  A source with target/size = 2.4 takes every document twice and chooses four tenths of its words
  a third time.  Documents with more than 1/``LARGE`` of a source's words are chosen first, from the largest on: one is
  taken when that keeps the words taken near their share, or when those that follow cannot fill the target any more.
  The others fill what is left by a systematic sample: documents in the order of size, every 1/rate-th is taken, from
  the one of a few seeded starts that comes nearest.  A large source is cut into slices by a seeded hash, each sampled
  alone, so that none is sorted in one task.  Some ``SEEDED`` documents of every source are kept out of it and chosen
  last, as the large ones are; they make up for what the slices missed.

Results that are defined: a null or empty text has size 0 and is taken 0 words; a null source is a source of its
own, after all others; sources without words have target 0; repeated rows are documents of their own; an empty
table gives an empty result.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.common import WORD, field, packed, stored, unpacked

#: Rows of one slice, sorted by one task.
ROWS_PER_SLICE = 10_000
#: Seeded starts of the systematic sample that are tried; the one nearest to the target is kept.
STARTS = 16
#: Documents with more than one LARGE-th of a source's words are chosen one by one; there are fewer than LARGE of them.
LARGE = 128
#: Expected number of the others that are chosen one by one, after the slices.
SEEDED = 64


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def cycled_weights(weights: Sequence[float]) -> Column:
    """Weights repeating over the sources in the order of code points, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights))).cast("int") + 1)


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """``sources`` (source, weight, source_size, more) with the ``target`` of each.

    The windows run over the table of sources, one row each, never over documents.
    """
    everything = Window.partitionBy()
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(float(max_epochs))
    levels = (
        sources.withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_words", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_used", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_words") - F.col("_used")) / (F.col("_weights") - F.col("_gone")))
    )
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything)
    return levels.withColumn("target", F.least("_cap", F.coalesce(F.col("weight") * level, F.col("_cap")))).drop(
        "_cap", "_ratio", "_words", "_weights", "_used", "_gone", "_level"
    )


def unit(text: Column) -> Column:
    """A number in [0, 1) from a string."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def repetitions(
    sized: DataFrame, weights: Sequence[float], max_epochs: float, seed: int, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``sized`` (source, size, tie, more) with source_size, target, copies and taken."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    slices = F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(float(rows_per_slice))))
    plan = (
        water_fill(totals.withColumn("weight", cycled_weights(weights)), max_epochs)
        .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_part", F.col("_rate") - F.floor("_rate"))
        .withColumn("_slices", slices)
        .withColumnRenamed("source", "_source")
        .drop("weight")
    )
    number = F.conv(F.substring("tie", 9, 8), 16, 10).cast("bigint")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_slice", F.pmod(number, F.col("_slices")))
    chosen = balanced(rows, seed)
    return (
        chosen.withColumn("copies", F.floor("_rate") + F.col("_extra"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_source", "_rate", "_part", "_rows", "_slices", "_slice", "_extra")
    )


def systematic(rows: DataFrame, seed: int) -> DataFrame:
    """Rows (source, size, tie, _slice, _part, more) with ``_extra``, 1 for those chosen from every slice."""
    start = unit(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("")), F.col("_slice").cast("string")))
    window = Window.partitionBy("source", "_slice").orderBy("size", "tie")
    group = Window.partitionBy("source", "_slice")
    part = F.col("_part")

    def chosen(start: Column) -> Column:
        return F.floor(F.col("_place") * part + start) - F.floor((F.col("_place") - 1) * part + start)

    tried = [F.pmod(F.col("_start") + F.lit(k / STARTS), F.lit(1.0)) for k in range(STARTS)]
    misses = F.array(
        *(F.abs(F.sum(F.col("size") * chosen(s)).over(group) - part * F.sum("size").over(group)) for s in tried)
    )
    best = F.element_at(F.array(*tried), F.array_position("_misses", F.array_min("_misses")).cast("int"))
    return (
        rows.repartition("source", "_slice")  # by both: a hot source is spread over its slices
        .withColumn("_place", F.row_number().over(window))
        .withColumn("_start", start)
        .withColumn("_misses", misses)
        .withColumn("_extra", chosen(best))
        .drop("_place", "_start", "_misses")
    )


def words_in(docs: Column) -> Column:
    return F.aggregate(docs, F.lit(0).cast("bigint"), lambda total, d: total + d["size"])


def choice(docs: Column, wanted: Column, later: Column) -> Column:
    """For every one of ``docs`` (size, tie, draw; largest first) 1 if it is chosen, else 0.

    Their words and some of the ``later`` ones are to be ``wanted``.  Of several seeded tries the nearest is kept.
    """
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), wanted / F.greatest(F.lit(1), words_in(docs) + later)))
    state = F.struct(
        F.lit(0.0).alias("taken"), F.lit(0.0).alias("due"), (words_in(docs) + later).cast("double").alias("rest"),
        F.array().cast("array<bigint>").alias("chosen"),
    )

    def tried(k: Column) -> Column:
        def step(s: Column, d: Column) -> Column:
            size = d["size"].cast("double")
            bar = F.when(k == 0, F.lit(0.5)).otherwise(F.pmod(d["draw"] * (2 * k + 1), F.lit(1.0)))
            due, left, rest = s["due"] + share * size, wanted - s["taken"], s["rest"] - size
            take = ((due - s["taken"] >= bar * size) & (size <= left)) | (left - rest >= size / 2)
            one = F.when(take, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
            return F.struct(
                (s["taken"] + one * size).alias("taken"), due.alias("due"), rest.alias("rest"),
                F.concat(s["chosen"], F.array(one)).alias("chosen"),
            )

        def result(s: Column) -> Column:
            left = wanted - s["taken"]
            return F.struct(F.greatest(F.lit(0.0), -left, left - later).alias("miss"), k.alias("k"), s["chosen"].alias("chosen"))

        return F.aggregate(docs, state, step, result)

    return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(STARTS - 1)), tried))["chosen"]


def chosen_words(docs: str, chosen: str) -> Column:
    return F.aggregate(F.zip_with(docs, chosen, lambda d, n: d["size"] * n), F.lit(0).cast("bigint"), lambda a, b: a + b)


def balanced(rows: DataFrame, seed: int) -> DataFrame:
    """Rows (source, size, tie, source_size, _rows, _slice, _part, more) with ``_extra``, 1 for those chosen.

    Large documents first, then the slices of the others, then the ones that were kept for what is missing.
    """
    drawn = F.pmod(F.xxhash64("tie", "size"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    large = F.col("size") * LARGE > F.col("source_size")
    classed = rows.withColumn("_class", F.when(large, 0).when(drawn * F.col("_rows") < SEEDED, 1).otherwise(2))

    def listed(of: int) -> Column:
        one = F.when(F.col("_class") == of, F.struct("size", "tie", unit(F.col("tie")).alias("draw")))
        return F.sort_array(F.collect_list(one), asc=False)

    sources = (
        classed.filter("_class < 2").groupBy(F.col("source").alias("_of"))
        .agg(listed(0).alias("_large"), listed(1).alias("_seeded"), F.first("_part").alias("_share"), F.first("source_size").alias("_words"))
        .withColumn("_wanted", F.col("_share") * F.col("_words"))
        .withColumn("_later", F.col("_words") - words_in(F.col("_large")))
        .withColumn("_first", choice(F.col("_large"), F.col("_wanted"), F.col("_later")))
        .withColumn("_left", F.col("_wanted") - chosen_words("_large", "_first"))
        .withColumn("_new", F.when(F.col("_later") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_left") / F.col("_later")))).otherwise(0.0))
    )
    same = F.col("source").eqNullSafe(F.col("_of"))
    rest = classed.filter("_class = 2").join(sources.select("_of", "_new"), same, "left")
    rest = systematic(rest.withColumn("_part", F.coalesce("_new", "_part")).drop("_of", "_new"), seed)
    sampled = rest.groupBy("source").agg(F.sum(F.col("size") * F.col("_extra")).alias("_sampled"))
    fills = F.col("_left") - F.coalesce("_sampled", F.lit(0))
    decided = sources.join(sampled, same, "left").select(
        "_of", "_first", choice(F.col("_seeded"), fills, F.lit(0)).alias("_second")
    )
    order = Window.partitionBy("source", "_class").orderBy(F.desc("size"), F.desc("tie"))
    single = (
        classed.filter("_class < 2").withColumn("_place", F.row_number().over(order)).join(decided, same)
        .withColumn("_extra", F.element_at(F.when(F.col("_class") == 0, F.col("_first")).otherwise(F.col("_second")), F.col("_place")))
        .drop("_place", "_of", "_first", "_second")
    )
    return rest.unionByName(single).drop("_class")


def sizes(docs: DataFrame, seed: int, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What the mix needs of every document: key, source, size and a seeded tie-breaker."""
    tie = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))
    return docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), tie.alias("tie"),
    )


def mix_plan(
    docs: DataFrame, weights: Sequence[float], max_epochs: float = 3.0, seed: int = 1,
    key: str = "doc_id", text: str = "text", source: str = "source", rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Per document: key, source, size, source_size, target (of its source), copies and taken words.

    Texts are read once; their sizes are stored and everything else works on these.
    """
    sized = stored(sizes(docs, seed, key, text, source), "sizes")
    found = repetitions(sized, weights, max_epochs, seed, rows_per_slice)
    return found.drop("tie").withColumnRenamed("key", key)


def mix(
    docs: DataFrame, weights: Sequence[float], max_epochs: float = 3.0, seed: int = 1,
    key: str = "doc_id", text: str = "text", source: str = "source", rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The mixed documents themselves: every row as often as the mix takes it, all columns kept."""
    tied = packed(docs).select(
        "row", field(source).cast("string").alias("source"), word_count(field(text)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(field(key).cast("string"), F.lit("")))).alias("tie"),
    )
    taken = repetitions(tied, weights, max_epochs, seed, rows_per_slice).filter("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return unpacked(repeated.drop("source"))
