"""Quality rules as a short-circuit cascade: the cost and the selectivity of every rule are estimated on a sample.

Built from DataFrame functions only.  A rule is a metric of the text and a limit.  On a bounded sample every rule is
timed and its rejections are counted; the cascade then asks the rules in the order of rejections per cost, as one
``CASE WHEN`` whose later branches Spark evaluates only for rows that no earlier one rejected.  The order decides
how much work is done, never which rows are kept.

Results that are defined: a null or empty text has no words, all metrics 0, and is rejected; repeated rows are
judged alike; an empty table gives an empty result (the rules then keep the order in which they are given).  Window
repeats are found by a 64-bit hash of the five words within one text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import BLANK, WORD, field, let, packed, unpacked

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Words in a window of the repetition rule.
WINDOW = 5
#: Rows of the sample the rules are timed on.
SAMPLE_ROWS = 500


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("bigint")


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_worded_lines(text)).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_worded_lines(text), lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint")


def repeated_words(found: Column) -> Column:
    """Words inside windows of five that occur at least twice.

    Only where some window hash repeats: hashes are sorted with their places, so that equal ones are neighbours; the
    places of those that have an equal neighbour are sorted again, and each adds the words the one before does not
    cover.
    """

    def repeated(ordered: Column) -> Column:
        places = F.transform(
            ordered,
            lambda x, k: F.when(
                F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(places, lambda p: p.isNotNull()))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, zero).otherwise(let(placed, lambda ordered: covered(repeated(ordered))))

    zero = F.lit(0).cast("bigint")
    starts = F.sequence(F.lit(1), F.size(found) - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, WINDOW)))
    return F.when(F.size(found) > WINDOW, let(windows, count)).otherwise(zero)


def word_metrics(found: Column) -> Column:
    """The metrics that need the words, from one pass over the text."""
    return F.struct(
        F.size(found).cast("bigint").alias("n_words"),
        F.length(F.array_join(found, "")).cast("bigint").alias("word_chars"),
        repeated_words(found).alias("n_repeat_words"),
    )


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, BLANK, "")).cast("bigint")


def n_repeat_words(text: Column) -> Column:
    return let(words(text), repeated_words)


def n_letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("bigint")


def n_upper(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint")


#: Metrics that ``word_metrics`` has together.
WORD_METRICS = ("n_words", "word_chars", "n_repeat_words")
METRICS: dict[str, Callable[[Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letters, n_upper)
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``fails`` holds for its metrics."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., Column]

    def on_text(self, text: Column) -> Column:
        return self.fails(*(METRICS[m](text) for m in self.needs))


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
)
RULES = (
    *BASE_RULES,
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
    Rule("shouting", ("n_upper", "word_chars"), lambda u, c: 2 * u > c),
    Rule("few_letters", ("n_letters", "word_chars"), lambda n, c: 2 * n < c),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(texts: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and share of rejected rows of every rule on the first ``sample_rows`` of ``texts`` (one column, text).

    The sample sets the order only; a sample unlike the rest costs time and changes no verdict.
    """
    sample = texts.sparkSession.createDataFrame(texts.head(sample_rows), texts.schema).cache()
    found = []
    nothing = None
    for rule in (None, None, *rules):  # twice nothing: to warm up, and for the time of a job that asks no rule
        asked = F.lit(False) if rule is None else rule.on_text(F.col("text"))
        began = time.perf_counter()
        n, rejected = sample.agg(F.count("*"), F.count_if(asked)).first()
        took = time.perf_counter() - began
        if rule is None:
            nothing = took
        else:
            found.append(Estimate(rule, max(took - nothing, 1e-3), rejected / max(n, 1)))
    sample.unpersist()
    return found


def ordered(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejections per cost, the best first; equal ones as given."""
    return [e.rule for e in sorted(estimates, key=lambda e: -e.gain)]


def first_failed(rules: Sequence[Rule], metric: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    verdict = None
    for rule in rules:
        fails = rule.fails(*(metric(m) for m in rule.needs))
        verdict = F.when(fails, rule.name) if verdict is None else verdict.when(fails, rule.name)
    return verdict


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The input columns and ``kept``; no metric is computed for a row after a rule has rejected it."""
    read = F.coalesce(field(text), F.lit(""))
    order = ordered(estimate(packed(docs).select(read.alias("text")), rules, sample_rows))
    judged = packed(docs).withColumn("kept", first_failed(order, lambda m: METRICS[m](read)).isNull())
    return unpacked(judged, "kept")


def judge(
    docs: DataFrame, report: Sequence[str], rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES,
    text: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The input columns, the metrics named in ``report`` for every row, ``base_failed`` and ``kept``.

    Reported metrics are computed once for all rows; the others only where the cascade asks for them.
    """
    read = F.coalesce(field(text), F.lit(""))
    order = ordered(estimate(packed(docs).select(read.alias("text")), rules, sample_rows))
    alone = {m: METRICS[m](read) for m in report if m not in WORD_METRICS}
    shared = {m: F.col("_words").getField(m) for m in report if m in WORD_METRICS}
    measured = packed(docs).withColumns({"_words": let(words(read), word_metrics), **alone}).withColumns(shared)

    def metric(name: str) -> Column:
        return F.col(name) if name in report else METRICS[name](read)

    failed = first_failed(base, metric).isNotNull()
    judged = measured.withColumns({"base_failed": failed, "kept": first_failed(order, metric).isNull()})
    return unpacked(judged, *report, "base_failed", "kept")
