"""SimHash near-duplicates: a grid range-join of segment bit counts under Manhattan distance.

* **Fingerprint.**  A bit is 1 if it is set in over half of the hashes of a text's shingles.
* **Embedding.**  A fingerprint becomes the vector of bit counts of its segments of two bits.  One differing bit moves
  one count by one, so the Manhattan distance of two vectors is a lower bound of the bit distance.  Counts are kept
  in unary (0, 1, 2 as 00, 01, 11), so a vector is one integer and the Manhattan distance of two is the number of
  bits in which these differ.
* **Grid join.**  The segments form ``2 d`` groups.  Vectors within distance ``d`` differ in at most ``d`` groups and
  share all counts of ``d`` others: they meet in the cell of at least one choice of ``d`` groups (20 choices for
  d = 3).  A cell fixes half of all counts, so few others share it.  A pair is taken in the first cell it shares,
  and only if the Manhattan distance, then the bit distance, is small enough.
* **Groups.**  Equal fingerprints are one node from the start; links join nodes to components
  (:mod:`gradewell.llm.components`).

Results that are defined: a null, empty or blank text has fingerprint 0 and is linked like any other; a text of fewer
words than a shingle is one shingle; repeated rows are in one component; null keys are the smallest of none
(component null if all are null); an empty table gives an empty result.  Input columns named like a result column give
way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import content_key, field, packed, stored
from gradewell.llm.components import components
from gradewell.operators.skew import hot_keys, join_split

BITS = 64
SEGMENT = 2
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Hashes whose bits are spread out at a time.
HASHES = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as a signed 64-bit number."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for first in range(0, n, HASHES):
        part = hashes[first : first + HASHES].view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t or b"", shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def hexadecimal(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), BITS // 4, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def embedding(number: Column) -> Column:
    """Bit counts of the two-bit segments in unary: the bits of every segment, the ones first."""
    low = F.lit(_signed(int("01" * (BITS // SEGMENT), 2)))
    beside = F.shiftrightunsigned(number, 1)
    least_one = number.bitwiseOR(beside).bitwiseAND(low)
    both = number.bitwiseAND(beside).bitwiseAND(low)
    return least_one.bitwiseOR(F.shiftleft(both, 1))


def group_masks(groups: int) -> list[int]:
    """The bits of every group of segments, groups as equal as can be."""
    segments = BITS // SEGMENT
    cuts = [segments * k // groups * SEGMENT for k in range(groups + 1)]
    return [_signed((1 << end) - (1 << start)) for start, end in zip(cuts, cuts[1:])]


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a > b) of the fingerprints in ``distinct`` (fp, each once) that differ in 1 to ``distance`` bits."""
    masks = group_masks(2 * distance)
    choices = list(combinations(range(2 * distance), distance))
    vector = embedding(F.col("fp"))
    cells = F.array(
        *(
            F.struct(F.lit(k).alias("choice"), vector.bitwiseAND(F.lit(_signed(sum(masks[g] % (1 << BITS) for g in c)))).alias("cell"))
            for k, c in enumerate(choices)
        )
    )
    placed = distinct.select("fp", F.inline(cells))
    a = placed.select("choice", "cell", F.col("fp").alias("a"))
    b = placed.select("choice", "cell", F.col("fp").alias("b"))
    apart = embedding(F.col("a")).bitwiseXOR(embedding(F.col("b")))
    # the first choice among the groups without a difference, by the set of these groups
    first = [0] * (1 << 2 * distance)
    for same in range(len(first)):
        found = [g for g in range(2 * distance) if same >> g & 1][:distance]
        first[same] = choices.index(tuple(found)) if len(found) == distance else -1
    same_groups = sum(
        (F.when(apart.bitwiseAND(F.lit(m)) == 0, 1 << g).otherwise(0) for g, m in enumerate(masks)), F.lit(0)
    )
    return (
        a.join(b, ["choice", "cell"])
        .filter(F.col("a") > F.col("b"))
        .filter(F.bit_count(apart) <= distance)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .filter(F.element_at(F.array(*map(F.lit, first)), same_groups + 1) == F.col("choice"))
        .select("a", "b")
    )


def _labelled(docs: DataFrame, shingle: int, distance: int, key: str, text: str) -> DataFrame:
    """Per document: key, text hash, fingerprint, the root of its component and that component's smallest key."""
    marked = stored(
        packed(docs).select(
            field(key).alias("key"), *content_key(field(text)), fingerprints(field(text), shingle).alias("fp")
        ),
        "fingerprints",
    )
    distinct = stored(
        marked.groupBy("fp").agg(F.min("key").alias("key"), F.count("*").alias("n_rows")), "distinct-fingerprints"
    )
    roots = components(links(distinct.select("fp"), distance))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "key", F.coalesce("root", "fp").alias("root")
    )
    smallest = joined.groupBy("root").agg(F.min("key").alias("component_id"))
    named = joined.join(smallest, "root").select("fp", "root", "component_id")
    total = distinct.agg(F.sum("n_rows")).first()[0] or 0
    hot = hot_keys(distinct, ["fp"], F.lit(total))  # many copies of one text: spread over several tasks
    return join_split(marked, named, ["fp"], hot, "key")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: key, fp (signed), fingerprint (16 hex digits), component_id (smallest key of its component)."""
    found = _labelled(docs, shingle, distance, key, text)
    return found.select(F.col("key").alias(key), "fp", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def dedup(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of every component, the one with its smallest key (null last); all columns kept.

    Among documents of that key the smallest text hash decides; documents equal in both are one.
    """
    found = _labelled(docs, shingle, distance, key, text)
    order = F.struct(F.col("key").isNull(), "key", "_h1", "_h2")
    kept = stored(found.groupBy("root").agg(F.min(order).alias("kept")).select("kept.key", "kept._h1", "kept._h2"), "kept")
    ident = {"_key": field(key), **dict(zip(("_t1", "_t2"), content_key(field(text))))}
    whole = packed(docs).withColumns(ident)
    same = F.col("_key").eqNullSafe(F.col("key")) & (F.col("_t1") == F.col("_h1")) & (F.col("_t2") == F.col("_h2"))
    return whole.join(kept, same, "left_semi").dropDuplicates(list(ident)).select("row.*")
