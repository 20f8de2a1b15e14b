"""Preference formatting: the common start of two conversations as prompt, what follows as paired completions.

A pair has a chosen and a rejected conversation.  Turns (role and text) are compared from the first on; the longest
common prefix is rendered once as the prompt.  The rest of each side is rendered as a completion with the spans of
characters that are trained on: the texts of the assistant and the mark that ends them.

A conversation is one training example and is rendered in one task; many conversations of one text, role or first
turn do not meet anywhere, as rows are grouped by conversation only.

Results that are defined: turns without a conversation are in none; rows that repeat are one turn; turns of the same
number are ordered by role and text (null first); a null role or text is rendered as empty, and equals only null;
equal conversations give two empty completions; an empty table
gives an empty result.  Other columns of the turns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, packed, stored

TRAINED_ROLE = "assistant"
OPEN, AFTER_ROLE, END, AFTER = "<|", "|>\n", "<|end|>", "\n"
COLUMNS = ["prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
RESULT = (
    "prompt_turns bigint, prompt string, chosen string, chosen_mask array<struct<start: bigint, end: bigint>>, "
    "rejected string, rejected_mask array<struct<start: bigint, end: bigint>>"
)

Turn = tuple[str | None, str | None]


def common_turns(chosen: Sequence[Turn], rejected: Sequence[Turn]) -> int:
    """Length of the longest common prefix."""
    differing = (k for k, (a, b) in enumerate(zip(chosen, rejected)) if a != b)
    return next(differing, min(len(chosen), len(rejected)))


def render(turns: Sequence[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The turns as text, and the spans of characters to train on."""
    parts, spans, length = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{role or ''}{AFTER_ROLE}", f"{text or ''}{END}"
        if role == TRAINED_ROLE:
            spans.append((length + len(head), length + len(head) + len(body)))
        parts += [head, body, AFTER]
        length += len(head) + len(body) + len(AFTER)
    return "".join(parts), spans


def format_pair(chosen: Sequence[Turn], rejected: Sequence[Turn]) -> dict:
    n = common_turns(chosen, rejected)
    prompt, _ = render(chosen[:n])
    (good, good_mask), (bad, bad_mask) = render(chosen[n:]), render(rejected[n:])
    return {
        "prompt_turns": n, "prompt": prompt, "chosen": good, "chosen_mask": good_mask, "rejected": bad,
        "rejected_mask": bad_mask,
    }


def _formatted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    def turns(found) -> list[Turn]:
        return [(t["role"], t["text"]) for t in found]

    for chosen, rejected in batches:
        rows = [format_pair(turns(a), turns(b)) for a, b in zip(chosen, rejected)]
        for row in rows:
            for mask in ("chosen_mask", "rejected_mask"):
                row[mask] = [{"start": a, "end": b} for a, b in row[mask]]
        yield pd.DataFrame(rows, columns=COLUMNS)


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: key and its ``turns`` (array of role and text) in order."""
    each = packed(turns).select(
        field(key).alias("key"),
        F.struct(field(turn).alias("turn"), field(role).alias("role"), field(text).alias("text")).alias("one"),
    )
    ordered = F.array_sort(F.collect_set("one"))
    plain = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return each.filter(F.col("key").isNotNull()).groupBy("key").agg(plain.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` has pair, chosen and rejected (arrays of turns); returns pair and the formatted columns."""
    def rendered(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _formatted(batches)

    return pairs.select("pair", F.pandas_udf(rendered, RESULT)("chosen", "rejected").alias("f")).select("pair", "f.*")


def with_other_answer(own: Column, other: Column) -> Column:
    """The turns of a conversation with the last answer of the assistant taken from ``other``."""
    last = F.array_max(F.transform(own, lambda t, k: F.when(t["role"] == TRAINED_ROLE, k)))
    answer = F.element_at(F.filter(other, lambda t: t["role"] == TRAINED_ROLE), -1)
    return F.transform(
        own, lambda t, k: F.when(k == last, F.struct(t["role"].alias("role"), answer["text"].alias("text"))).otherwise(t)
    )


def mismatched_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each with itself, but answered as its neighbour's last turn was.

    The neighbour of an even key is the next key, that of an odd one the key before; keys that are no numbers have none.
    Every conversation gives a pair: without another answer the rejected side ends before the answer, and a conversation
    that has no answer itself is paired with itself.
    """
    whole = conversations(turns)
    answers = F.filter("turns", lambda t: t["role"] == TRAINED_ROLE)
    own = stored(whole.withColumn("answers", F.slice(answers, -1, 1)).withColumn("answers", F.when(F.size(answers) > 0, F.col("answers"))), "conversations")
    number = F.col("key").cast("string").try_cast("bigint")
    number = F.when(number.cast("string") == F.col("key").cast("string"), number)  # "007" is no number
    other = own.filter("answers IS NOT NULL").select(number.bitwiseXOR(F.lit(1).cast("bigint")).alias("_of"), F.col("answers").alias("other"))
    last = F.array_max(F.transform("turns", lambda t, k: F.when(t["role"] == TRAINED_ROLE, k)))
    before = F.slice("turns", F.lit(1), F.coalesce(last, F.lit(0)))
    rejected = (
        F.when(F.col("answers").isNull(), F.col("turns"))
        .when(F.col("other").isNull(), before)
        .otherwise(with_other_answer(F.col("turns"), F.col("other")))
    )
    return own.join(other, number == F.col("_of"), "left").select(F.col("key").alias("pair"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
