"""Benchmark decontamination over a distributed positional inverted index.

* **Index.**  The training documents are cut into shards of a bounded number of words.  A shard is one stored row: its
  terms and, for each, the sorted places where it stands.  Documents of a shard are ``GAP`` places apart, so no phrase
  reaches from one into the next.  Every word of every document is indexed; shards do not depend on each other.
* **Search.**  Test items are cut into windows of consecutive words (an item shorter than a window is one window).  In
  each shard a window whose terms do not all occur is dropped at once.  For the others the places of the rarest term,
  moved by its offset, are the candidate starts; the lists of the other terms, the next rarest first, are moved by
  their offsets and intersected with them.  ``slop`` 0 gives exact phrases; otherwise every term may stand up to
  that many words beside its place, which gives proximity matches.
* **Test sets of any size** are taken in blocks of bounded size, each sent to every task; what the blocks find is
  merged per document.

Results that are defined: a null or empty text, or an item without words, has no windows and is never hit; an item
without an id counts for hit words but not among the items; items of the same id are one item; repeated documents
are all returned; empty tables give results without hits.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import content_key, field, packed, scratch

WINDOW = 10
#: Words of a shard, besides its last document.
SHARD_WORDS = 1 << 17
GAP = 64
#: Characters of test items in one block.
BLOCK_CHARS = 4 << 20
#: Contaminated texts up to this many (16 bytes each) are sent to every task when documents are dropped.
BROADCAST_ROWS = 500_000
#: Postings are sorted by term number and place, packed into one integer.
TERM = 32

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
_KEPT = {*range(ord("0"), ord("9") + 1), *_LETTERS, *range(0x80, 0x100)}
#: Bytes of words as they are, A-Z lower-cased, all others a blank.
FOLD = bytes(b if b in _KEPT else b + 32 if b + 32 in _LETTERS and b < 0x5B else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and anything that is not ASCII."""
    return text.translate(FOLD).split()


# --- index ------------------------------------------------------------------------------------


class _Shard:
    """Documents gathered for one row of the index."""

    def __init__(self) -> None:
        self.keys: list = []
        self.hashes: list[tuple[int, int]] = []
        self.lengths: list[int] = []
        self.words: list[bytes] = []

    def add(self, key, hashes: tuple[int, int], found: list[bytes]) -> None:
        self.keys.append(key)
        self.hashes.append(hashes)
        self.lengths.append(len(found))
        self.words += found

    def row(self, number: int) -> dict:
        lengths = np.array(self.lengths, np.int64)
        first = np.cumsum(lengths + GAP) - lengths - GAP
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        term = np.fromiter(map(numbers.__getitem__, self.words), np.int64, len(self.words))
        place = np.arange(len(term)) + np.repeat(np.arange(len(lengths)) * GAP, lengths)
        postings = term << TERM | place
        postings.sort()
        starts = np.searchsorted(postings, np.arange(len(numbers) + 1) << TERM)
        return {
            "shard": number, "doc_key": self.keys, "doc_h1": [h for h, _ in self.hashes],
            "doc_h2": [h for _, h in self.hashes], "doc_first": first, "doc_words": lengths, "terms": list(numbers),
            "starts": starts.astype(np.int32), "places": (postings & (1 << TERM) - 1).astype(np.int32),
        }


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, base, made = _Shard(), TaskContext.get().partitionId() << 32, count()
    key_type = None

    def done() -> pa.RecordBatch:
        row = shard.row(base | next(made))
        types = {
            "shard": pa.int64(), "doc_key": pa.list_(key_type), "doc_h1": pa.list_(pa.int64()), "doc_h2": pa.list_(pa.int64()),
            "doc_first": pa.list_(pa.int64()), "doc_words": pa.list_(pa.int64()), "terms": pa.list_(pa.binary()),
            "starts": pa.list_(pa.int32()), "places": pa.list_(pa.int32()),
        }
        return pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in types.items()], list(types))

    for batch in batches:
        key_type = batch.column("key").type
        texts = batch.column("text").cast(pa.binary())
        columns = zip(batch.column("key").to_pylist(), batch.column("_h1").to_pylist(), batch.column("_h2").to_pylist(), texts)
        for key, h1, h2, text in columns:
            shard.add(key, (h1, h2), words(text.as_py() or b""))
            if len(shard.words) + GAP * len(shard.keys) >= SHARD_WORDS:
                yield done()
                shard = _Shard()
    if shard.keys:
        yield done()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all words of ``docs``."""
    read = packed(docs).select(field(key).alias("key"), field(text).alias("text"), *content_key(field(text)))
    key_type = read.schema["key"].dataType.simpleString()
    schema = (
        f"shard bigint, doc_key array<{key_type}>, doc_h1 array<bigint>, doc_h2 array<bigint>, doc_first array<bigint>, "
        "doc_words array<bigint>, terms array<binary>, starts array<int>, places array<int>"
    )
    path = scratch(docs.sparkSession, "postings")
    read.mapInArrow(_index, schema).write.option("parquet.block.size", 16 << 20).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


# --- search -----------------------------------------------------------------------------------


class Windows(NamedTuple):
    """Distinct windows of a block of test items."""

    terms: list[bytes]
    #: By window length: a row of term numbers for each window.
    rows: dict[int, np.ndarray]
    #: By window length: the items of each window.
    items: dict[int, list[list[str]]]


def windows_of(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Windows:
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        ids = [numbers[w] for w in words((text or "").encode())]
        size = min(window, len(ids))
        for k in range(len(ids) - size + 1 if size else 0):
            owners = found[size][tuple(ids[k : k + size])]
            if item is not None:
                owners.add(item)
    rows = {size: np.array(list(each), np.int64) for size, each in found.items()}
    return Windows(list(numbers), rows, {size: [sorted(o) for o in each.values()] for size, each in found.items()})


def matches(postings: np.ndarray, rows: np.ndarray, n_terms: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows found, and the places of all their words (one row for each occurrence).

    An occurrence has a start from which every term stands at its offset, or up to ``slop`` words beside it; a word
    stands for one term only.  Equal terms of a window take places in the order of their offsets, each the first left:
    their ranges are of one length and begin in that order, so no other choice finds more.
    """
    bounds = np.searchsorted(postings, np.arange(n_terms + 1) << TERM)
    lengths = np.diff(bounds)
    size = rows.shape[1]
    alive = np.flatnonzero((lengths[rows] > 0).all(axis=1))
    order = np.argsort(lengths[rows[alive]], axis=1, kind="stable")
    rarest = rows[alive, order[:, 0]]
    window = np.repeat(np.arange(len(alive)), lengths[rarest])
    inside = np.arange(len(window)) - np.repeat(np.cumsum(lengths[rarest]) - lengths[rarest], lengths[rarest])
    place = postings[bounds[rarest][window] + inside] & (1 << TERM) - 1
    shifts = np.arange(-slop, slop + 1)
    window, place = np.repeat(window, len(shifts)), np.repeat(place, len(shifts))
    start = place - order[window, 0] + np.tile(shifts, len(inside))
    found = np.zeros((len(window), size), np.int64)
    found[np.arange(len(window)), order[window, 0]] = place
    before = np.full_like(rows, -1)  # the offset of the same term before, or -1
    for k in range(1, size) if slop else ():
        for j in range(k):
            before[rows[:, j] == rows[:, k], k] = j
    for k in range(1, size):
        offset = order[window, k]
        term = rows[alive[window], offset] << TERM
        low, high = start + offset - slop, start + offset + slop
        same = before[alive[window], offset]
        low = np.where(same < 0, low, np.maximum(low, found[np.arange(len(window)), same] + 1))
        at = np.minimum(np.searchsorted(postings, term + np.maximum(low, 0)), len(postings) - 1)
        keep = (high >= 0) & (postings[at] >= term + np.maximum(low, 0)) & (postings[at] <= term + np.maximum(high, 0))
        found[np.arange(len(window)), offset] = postings[at] & (1 << TERM) - 1
        window, start, found = window[keep], start[keep], found[keep]
    return alive[window], found


def _values(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def _search(asked: Windows, slop: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(asked.value.terms, pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                yield one(batch, row, terms)

    def one(batch: pa.RecordBatch, row: int, terms: pa.Array) -> pa.RecordBatch:
        first = _values(batch, "doc_first", row).to_numpy()
        number = pc.index_in(_values(batch, "terms", row), value_set=terms).fill_null(-1).to_numpy()
        starts = _values(batch, "starts", row).to_numpy()
        lengths = np.diff(starts)
        of_place = np.repeat(number, lengths).astype(np.int64)
        places = _values(batch, "places", row).to_numpy()
        known = of_place >= 0
        postings = (of_place[known] << TERM) | places[known]
        postings.sort()
        hit: list[np.ndarray] = []
        owners: defaultdict[int, set[str]] = defaultdict(set)
        if len(postings):
            for size, rows in asked.value.rows.items():
                window, found = matches(postings, rows, len(terms), slop)
                hit.append(found.ravel())
                docs = np.searchsorted(first, found[:, 0], side="right") - 1
                for doc, w in np.unique(np.stack([docs, window], axis=1), axis=0).tolist():
                    owners[doc].update(asked.value.items[size][w])
        hit_places = np.unique(np.concatenate(hit)) if hit else np.empty(0, np.int64)
        doc = np.searchsorted(first, hit_places, side="right") - 1
        bounds = np.searchsorted(doc, np.arange(len(first) + 1))
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(batch.column("shard")[row], len(first)),
                pa.array(np.arange(len(first))),
                _values(batch, "doc_key", row), _values(batch, "doc_h1", row), _values(batch, "doc_h2", row),
                _values(batch, "doc_words", row),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hit_places - first[doc])),
                pa.array([sorted(owners.get(d, ())) for d in range(len(first))], pa.list_(pa.string())),
            ],
            ["shard", "place", "key", "h1", "h2", "n_words", "hit_words", "items"],
        )

    return search


def blocks(items: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[str | None, str | None]]]:
    """Test items in blocks of bounded size, one on the driver at a time."""
    block, size = [], 0
    for item, text in items.toLocalIterator():
        block.append((item, text))
        size += len(text or "") + 1
        if size >= chars:
            yield block
            block, size = [], 0
    yield block


def search(
    index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, item: str = "item_id", text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per indexed document: key, h1 and h2 (its text), n_words, hit_words (places), items (their ids)."""
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be below {GAP}")
    spark = index.sparkSession
    key_type = index.schema["doc_key"].dataType.elementType.simpleString()
    schema = (
        f"shard bigint, place bigint, key {key_type}, h1 bigint, h2 bigint, n_words bigint, hit_words array<bigint>, "
        "items array<string>"
    )
    asked = packed(benchmark).select(field(item).cast("string"), field(text))
    found = [
        index.mapInArrow(_search(spark.sparkContext.broadcast(windows_of(block, window)), slop), schema)
        for block in blocks(asked, block_chars)
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    if len(found) > 1:
        result = result.groupBy("shard", "place").agg(
            *(F.first(c).alias(c) for c in ("key", "h1", "h2", "n_words")),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return result.drop("shard", "place")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents without any hit word, all columns kept."""
    found = search(build_index(docs, key, text), benchmark, window, slop, item, item_text)
    path = scratch(docs.sparkSession, "contaminated")
    found.filter(F.size("hit_words") > 0).select("h1", "h2").distinct().write.parquet(path)
    bad = docs.sparkSession.read.schema("h1 bigint, h2 bigint").parquet(path)
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    held = packed(docs).withColumns(dict(zip(("_h1", "_h2"), content_key(field(text)))))
    return held.join(bad, (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2")), "left_anti").select("row.*")
