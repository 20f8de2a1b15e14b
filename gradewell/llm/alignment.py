"""Cross-tokenizer alignment of a byte-level vocabulary (A) and a piece vocabulary with byte fallback (B).

Both read a space and the text.  Byte offsets at which tokens of both end cut them into groups, and the two tokens that
end there are a link.

* **Exact-text deduplication.**  Texts are shuffled whole (counted per task first, so copies meet as one row) and
  each distinct text is encoded and aligned once.  Its links are stored as distinct pairs with their number.
* **Counts.**  A pair of ids is counted over all documents: links of a distinct text times the documents that have it.
* **Measures.**  A text's links meet the counts, and its measures travel to the documents by the SHA-256 of the text.
  Counts of up to ``BROADCAST_PAIRS`` pairs (17 bytes each) are sent to every task; more are joined by sorting, frequent
  pairs split over several tasks.

A space after a non-blank starts a token in both vocabularies, so a text is encoded in parts between such places, and
the alignment of a part is remembered.

Results that are defined: a null or empty text, or one that a vocabulary does not give back byte by byte, has no tokens:
zeros and an empty ``groups``; it has no part in the counts; repeated rows are documents of their own and add to the counts;
null keys are kept; an empty table gives an empty result.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm import vocabulary
from gradewell.llm.common import field, packed, stored, unpacked
from gradewell.operators.skew import ROWS_PER_TASK, hot_keys, join_split

#: Pairs whose counts may be sent to every task.
BROADCAST_PAIRS = 2_000_000
#: Parts of texts a task remembers, new ones that are encoded together, and characters that are read at a time.
MEMORY, TOGETHER, SLICE = 200_000, 5_000, 1 << 20
#: A space after a non-blank, before more than spaces.
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")
#: Parts of characters whose classes are plain, and how A cuts them.
_PLAIN = re.compile(r"[ -~À-ÖØ-öø-ÿ]+").fullmatch
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, groups string, pairs array<bigint>, times array<bigint>"


class Part(NamedTuple):
    """Alignment of one part of a text; ``pairs`` has A's id above 32 bits of B's, one long a link."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes


def _cuts(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of tokens up to each of the ends ``at``."""
    return np.searchsorted(ends, at) + 1


class Aligner:
    """Encodes texts by both vocabularies and aligns them.

    A part of plain characters is cut as A does it and A's model splits the pieces; A's library encodes every other part.
    """

    def __init__(self, name_a: str, name_b: str) -> None:
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(vocabulary.path(name_a))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.model = self.a.model
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path(name_b))
        alphabet = vocabulary.byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in alphabet for c in token):
                self.bytes_a[i] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a, self.sizes_b = (np.array([*map(len, known)], np.int64) for known in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = np.array([[f"{i}{mark}" for i in range(most)] for mark in ",|;"], object)
        #: Texts may be cut before a space only if no piece of B goes on across one.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.pieces = vocabulary.Recent(self._pieces, MEMORY)
        self.parts = vocabulary.Recent(self._parts, MEMORY)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        spell, split, whole = vocabulary.SPELLED, self.model.tokenize, self.a.encode
        return [
            array("q", [t.id for t in split(p.translate(spell))] if _PLAIN(p) else whole(p, add_special_tokens=False).ids).tobytes()
            for p in pieces
        ]

    def _ids_a(self, parts: list[str]) -> np.ndarray:
        cut = (_PIECE.findall(p) if _PLAIN(p) else (p,) for p in parts)
        return np.frombuffer(b"".join(next(self.pieces.each([list(chain.from_iterable(cut))]))), np.int64)

    def together(self, parts: list[str]) -> list[Part] | None:
        """Alignments of parts that start with a space and may be joined; None if not all bytes come back."""
        joined = "".join(parts)
        data, a, b = joined.encode(), self._ids_a(parts), self.b.encode(joined[1:], num_threads=1)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != data or b"".join(map(self.bytes_b.__getitem__, b)) != data:
            return None
        b = np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        cut_a, cut_b = _cuts(ends_a, common), _cuts(ends_b, common)  # tokens up to the end of every group
        pairs = a[cut_a - 1] << 32 | b[cut_b - 1]

        # a group is written as its A tokens, each with a comma but the last, and its B tokens in the same way
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
        group_a, group_b = np.repeat(np.arange(len(common)), np.diff(cut_a, prepend=0)), np.repeat(np.arange(len(common)), np.diff(cut_b, prepend=0))
        texts = np.empty(len(a) + len(b), object)
        texts[np.arange(len(a)) + np.concatenate([[0], cut_b])[group_a]] = self.written[mark_a, a]
        texts[np.arange(len(b)) + cut_a[group_b]] = self.written[mark_b, b]
        texts = texts.tolist()

        ends = np.cumsum([len(p.encode()) for p in parts])
        last = np.searchsorted(common, ends)  # a part ends where tokens of both do
        n_a, n_b, n_groups = cut_a[last], cut_b[last], last + 1
        bounds = zip(n_a.tolist(), n_b.tolist(), n_groups.tolist())
        found, i, j, k = [], 0, 0, 0
        for to_a, to_b, to_k in bounds:
            groups = "".join(texts[i + j : to_a + to_b])[:-1]
            found.append(Part(to_a - i, to_b - j, to_k - k, groups, pairs[k:to_k].tobytes()))
            i, j, k = to_a, to_b, to_k
        return found

    def _parts(self, parts: list[str]) -> Iterator[Part | tuple]:
        """Alignment of every part, an empty tuple for those whose bytes do not come back.

        Parts that start with a space and end without one are encoded together, as text that can be cut there.
        """
        for first in range(0, len(parts), TOGETHER):
            some = parts[first : first + TOGETHER]
            fit = [p for p in some if not p[-1].isspace()] if self.cuts else []
            found = dict(zip(fit, self.together(fit) or ())) if fit else {}
            for part in some:
                yield found[part] if part in found else (self.together([part]) or [()])[0]

    def align(self, texts: Iterable[str]) -> Iterator[tuple | None]:
        """For every text its numbers of tokens of either kind and of groups, the groups, distinct pairs and their times."""
        for some in vocabulary.slices(texts, SLICE):
            cut = [[] if not t else _CUT.split(" " + t) if self.cuts else [" " + t] for t in some]
            for parts in self.parts.each(cut):
                if not parts or () in parts:
                    yield None
                    continue
                n_a, n_b, n_groups, groups, pairs = zip(*parts)
                links = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
                yield sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), *links


@cache
def aligner(name_a: str, name_b: str) -> Aligner:
    return Aligner(name_a, name_b)


_NONE = np.zeros(0, np.int64)


def distinct_texts(docs: DataFrame, name_a: str, name_b: str, text: str, digest_groups: bool) -> DataFrame:
    """One row a distinct text: digest, n_docs and its alignment, stored."""
    counted = packed(docs).select(F.coalesce(field(text), F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("n_docs"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        align = aligner(name_a, name_b).align
        with vocabulary.no_cycles():
            for texts in batches:
                rows = []
                for found in align(texts):
                    n_a, n_b, n_groups, groups, pairs, times = found or (0, 0, 0, "", _NONE, _NONE)
                    if digest_groups and found:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    rows.append((n_a, n_b, n_groups, groups, pairs, times))
                yield pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    found = counted.select(F.sha2("text", 256).alias("digest"), "n_docs", F.pandas_udf(run, ALIGNED)("text").alias("of"))
    return stored(found.select("digest", "n_docs", "of.*"), "aligned")


def pair_counts(texts: DataFrame) -> DataFrame:
    """Every pair of ids with its corpus-wide ``count`` and whether that is the highest of its B id (``best``), stored."""
    each = texts.filter("n_groups > 0").select("n_docs", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = each.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("link.times") * F.col("n_docs")).alias("count"))
    counts = stored(counts, "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    marked = counts.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    return stored(marked, "pairs")


def _measured_by_table(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Measures of every distinct text from a table of counts that every task holds."""
    table = pairs.orderBy("pair").toPandas()
    shared = texts.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy(np.int64), table["count"].to_numpy(np.int64), table["best"].to_numpy(bool))
    )

    @F.pandas_udf("n_links bigint, n_best bigint, count_sum bigint")
    def measures(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known, counts, best = shared.value
        for found, times in batches:
            rows = np.zeros((len(found), 3), np.int64)
            for k, (pair, n) in enumerate(zip(found, times)):
                if len(pair):
                    place = np.searchsorted(known, pair)
                    rows[k] = n.sum(), n[best[place]].sum(), (n * counts[place]).sum()
            yield pd.DataFrame(rows, columns=["n_links", "n_best", "count_sum"])

    return texts.withColumn("of", measures("pairs", "times")).select(
        "digest", "n_docs", "n_a", "n_b", "n_groups", "of.n_links", "of.n_best", "of.count_sum", "groups"
    )


def _measured_by_join(texts: DataFrame, pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """Measures of every distinct text, its links joined with the counts by sorting; frequent pairs are split."""
    links = texts.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("digest", F.col("link.pairs").alias("pair"), F.col("link.times").alias("n"))
    rows = pairs.withColumnRenamed("count", "n_rows")  # an upper bound of the texts that have a pair
    hot = hot_keys(rows, ["pair"], rows.agg(F.sum("n_rows")).scalar(), rows_per_task)
    met = join_split(links, pairs, ["pair"], hot, "digest")
    sums = met.groupBy("digest").agg(
        F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    return texts.join(sums, "digest", "left").select(
        "digest", "n_docs", "n_a", "n_b", "n_groups",
        *(F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")), "groups",
    )


def align(
    docs: DataFrame, name_a: str, name_b: str, text: str = "text", key: str = "doc_id", digest_groups: bool = False,
    broadcast_pairs: int = BROADCAST_PAIRS, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The input columns and the measures of every document.

    ``groups`` has the ids of every group (``a1,a2|b1;a3|b2,b3``), or with ``digest_groups`` the SHA-256 of that string.
    """
    texts = distinct_texts(docs, name_a, name_b, text, digest_groups)
    pairs = pair_counts(texts)
    few = pairs.count() <= broadcast_pairs
    measured = stored(_measured_by_table(texts, pairs) if few else _measured_by_join(texts, pairs, rows_per_task), "measures")
    counted = measured.select("digest", F.col("n_docs").alias("n_rows"))
    hot = hot_keys(counted, ["digest"], counted.agg(F.sum("n_rows")).scalar(), rows_per_task)
    whole = packed(docs).withColumns({"digest": F.sha2(F.coalesce(field(text), F.lit("")), 256), "_key": field(key)})
    return unpacked(join_split(whole, measured.drop("n_docs"), ["digest"], hot, "_key"), *MEASURES)
