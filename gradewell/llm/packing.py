"""Hierarchical multi-length packing of token sequences.

* **Tiers.**  Context sizes are the powers of two from ``SMALLEST`` to ``LARGEST``.  Whole windows of the largest size are
  cut off a document first; the rest is routed to the smallest tier that holds it.
* **Packing.**  Each tier keeps a stock.  Once that is full, its longest piece starts a window; the gap is
  filled with the longest piece that fits, from the tier itself down to the shortest one, and where none fits a piece is
  cut.  So windows are full, and long ones are topped up from shorter tiers.
* **Ends.**  When a task has read all its documents, its stocks go into windows from the largest tier down.  What then
  remains is shorter than the smallest tier; ``JOINED`` tasks put these remains into one window, the only one with padding.
* **Step groups.**  A finished window goes to one of a few open groups of ``STEP`` tokens, the one with room that has the
  smallest share of its tier, so groups are equal in tokens and alike in the lengths of their windows.

A task reads its documents one after the other and holds ids of a bounded stock and of one document; no row is moved but
the remains.  Documents are numbered by the task that reads them, so the table should be stored, as the query does.

Results that are defined: a null text is empty and an empty text is the closing id alone; repeated rows and rows with
a null key are documents of their own; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field as attribute
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm import vocabulary
from gradewell.llm.common import field, packed, stored

SMALLEST, LARGEST = 64, 4096
#: Tasks whose remains share one window: below SMALLEST tokens each.
JOINED = LARGEST // SMALLEST
#: Windows of a tier that are held back before one is packed.
STOCK = 8
#: Tokens of a step group, and groups a task fills at a time.
STEP = 16 * LARGEST
OPEN = 8
#: Words a task remembers, and characters it encodes at a time.
MEMORY, SLICE = 600_000, 1 << 20

#: Blanks of the vocabulary; of Python's own, these four characters are none.
_BLANK = re.compile(r"[^\S\x1c-\x1f]+")
_ODD = re.compile(r"[\x1c-\x1f]").search
#: Words of characters that no normalisation joins or splits, and how the vocabulary cuts them.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Rows a task sends at once.
ROWS = 10_000
PIECES = (
    "key {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "tier int, step_group bigint, task bigint"
)
COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


class Encoder:
    """Ids of texts for a byte-level vocabulary that drops white space, so that words between blanks are encoded on their own.

    A word of plain characters is lower-cased and cut as the vocabulary does it, and its model splits the pieces; the
    library encodes every other word as it is.
    """

    def __init__(self, name: str, closing: int | None) -> None:
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(vocabulary.path(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.closing = array("I", [] if closing is None else [closing]).tobytes()
        self.words = vocabulary.Recent(self._words, MEMORY)
        self.pieces = vocabulary.Recent(self._pieces, MEMORY)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        spell, split = vocabulary.SPELLED, self.model.tokenize
        return [array("I", [t.id for t in split(p if p.isascii() else p.translate(spell))]).tobytes() for p in pieces]

    def _cut(self, word: str) -> list[str]:
        """The pieces of a plain word; none for any other."""
        if word.isascii():
            if word.isalpha():
                return [word.lower()]
            return _PIECE.findall(word.lower()) if word.isprintable() and "<|" not in word else []
        return _PIECE.findall(word.lower()) if _PLAIN(word) and "<|" not in word else []

    def _words(self, words: list[str]) -> Iterator[bytes]:
        cut = list(map(self._cut, words))
        ids = iter(next(self.pieces.each([list(chain.from_iterable(cut))])))
        for word, pieces in zip(words, cut):
            if len(pieces) == 1:
                yield next(ids)
            elif pieces:
                yield b"".join(islice(ids, len(pieces)))
            else:
                yield array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of every text, with the closing one."""
        for some in vocabulary.slices(texts, SLICE):
            for found in self.words.each([_BLANK.split(t) if _ODD(t) else t.split() for t in some]):
                yield np.frombuffer(b"".join([*found, self.closing]), np.uint32)


@cache
def encoder(name: str, closing: int | None) -> Encoder:
    return Encoder(name, closing)


@dataclass
class Piece:
    """Consecutive ids of one document."""

    key: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.key, self.start, self.ids[:length], self.doc_tokens)
        return head, Piece(self.key, self.start + length, self.ids[length:].copy(), self.doc_tokens)


@dataclass
class Tier:
    """Stock of one context size, sorted by length."""

    size: int
    pieces: list[Piece] = attribute(default_factory=list)
    tokens: int = 0

    def put(self, piece: Piece) -> None:
        insort(self.pieces, piece, key=len)
        self.tokens += len(piece)

    def take(self, place: int) -> Piece:
        piece = self.pieces.pop(place)
        self.tokens -= len(piece)
        return piece

    def fitting(self, gap: int) -> int:
        """Place of the longest piece of at most ``gap`` ids, or -1."""
        return bisect_right(self.pieces, gap, key=len) - 1


@dataclass
class Group:
    """A step group being filled: its tokens, in all and by tier."""

    number: int
    tokens: int = 0
    by_tier: Counter = attribute(default_factory=Counter)


class Steps:
    """Step groups of equal tokens and alike in the tiers of their windows."""

    def __init__(self, number: Callable[[], int], size: int = STEP, most: int = OPEN) -> None:
        self.number, self.size, self.most = number, size, most
        self.groups: list[Group] = []

    def place(self, length: int) -> int:
        """The group of one more window: of those with room the one whose share of this tier is smallest."""
        while len(self.groups) < self.most:
            self.groups.append(Group(self.number()))
        room = [g for g in self.groups if g.tokens + length <= self.size]
        if not room:
            if len(self.groups) >= 2 * self.most:  # the fullest closes as it is
                self.groups.remove(max(self.groups, key=lambda g: g.tokens))
            room = [Group(self.number())]
            self.groups += room
        group = min(room, key=lambda g: (g.by_tier[length] / (g.tokens + self.size / 4), -g.tokens))
        group.tokens += length
        group.by_tier[length] += length
        if group.tokens == self.size:
            self.groups.remove(group)
        return group.number


class Packer:
    """Packs the documents of one task; windows come out as lists of rows."""

    def __init__(self, task: int, smallest: int = SMALLEST, largest: int = LARGEST, stock: int = STOCK) -> None:
        sizes = [smallest << k for k in range((largest // smallest).bit_length())]
        self.tiers = [Tier(s) for s in sizes]
        self.sizes, self.stock, self.task = sizes, stock, task
        self.sequences = self.step_numbers = 0
        self.steps = Steps(self._next_step, 16 * largest)

    def _next_step(self) -> int:
        self.step_numbers += 1
        return self.task << 40 | self.step_numbers - 1

    def _row(self, piece: Piece, sequence: int | None, offset: int, tier: int, step: int | None) -> tuple:
        crc = zlib.crc32(np.ascontiguousarray(piece.ids, "<u4").tobytes())
        return piece.key, piece.start, len(piece), crc, piece.doc_tokens, sequence, offset, tier, step, self.task

    def _window(self, pieces: list[Piece], size: int) -> list[tuple]:
        sequence, step = self.task << 40 | self.sequences, self.steps.place(size)
        self.sequences += 1
        rows, offset = [], 0
        for piece in pieces:
            rows.append(self._row(piece, sequence, offset, size, step))
            offset += len(piece)
        return rows

    def _route(self, piece: Piece) -> None:
        self.tiers[bisect_left(self.sizes, len(piece))].put(piece)

    def add(self, key: object, ids: np.ndarray) -> Iterator[tuple]:
        """Rows of the windows that are finished by one more document."""
        largest, rest = self.sizes[-1], Piece(key, 0, ids, len(ids))
        while len(rest) >= largest:
            window, rest = rest.cut(largest)
            yield from self._window([window], largest)
        if len(rest):
            self._route(rest)
        for tier in reversed(self.tiers):
            while tier.tokens >= self.stock * tier.size:
                yield from self._pack(tier.size)

    def _pack(self, size: int, longest: int | None = None) -> list[tuple]:
        """One full window from the stocks of its tier (or up to the tier ``longest``) and the shorter ones, which hold enough."""
        usable = [t for t in reversed(self.tiers) if t.size <= (longest or size)]
        pieces, gap = [], size
        while gap:
            found = next(((t, k) for t in usable if (k := t.fitting(gap)) >= 0), None)
            if found is None:  # every piece is longer: cut the shortest one
                tier = next(t for t in reversed(usable) if t.pieces)
                head, rest = tier.take(0).cut(gap)
                self._route(rest)
                pieces.append(head)
                break
            pieces.append(found[0].take(found[1]))
            gap -= len(pieces[-1])
        return self._window(pieces, size)

    def finish(self) -> Iterator[tuple]:
        """Rows of the last windows, then the remains without one."""
        for size in reversed(self.sizes):
            while sum(t.tokens for t in self.tiers) >= size:
                yield from self._pack(size, self.sizes[-1])
        for tier in self.tiers:
            for piece in tier.pieces:
                yield self._row(piece, None, 0, 0, None)


def pack(docs: DataFrame, vocabulary_name: str, closing: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier (size of its window), step_group.

    The pieces of a document follow each other without gap or overlap; ``closing`` is put after its ids.
    """
    given = packed(docs).select(field(key).alias("key"), F.coalesce(field(text), F.lit("")).alias("text"))
    schema = PIECES.format(key=given.schema["key"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(vocabulary_name, closing), Packer(TaskContext.get().partitionId())
        kind = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * 6, pa.int32(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], COLUMNS)

        with vocabulary.no_cycles():
            for batch in batches:
                kind, rows = batch.schema.field(0).type, []
                for one, ids in zip(batch.column(0).to_pylist(), encode.ids(batch.column(1).to_pylist())):
                    rows += packer.add(one, ids)
                    if len(rows) >= ROWS:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)
            if rows := list(packer.finish()):
                yield batch_of(rows)

    pieces = stored(given.mapInArrow(run, schema), "pieces")
    window = Window.partitionBy("_of").orderBy("task", "key", "start", "ids_crc32")
    joined = (
        pieces.filter("sequence_id IS NULL")  # fewer than SMALLEST tokens a task
        .withColumn("_of", F.floor(F.col("task") / JOINED))
        .withColumn("offset", F.coalesce(F.sum("length").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("sequence_id", F.lit(1 << 62) + F.col("_of"))
        .withColumn("step_group", F.col("sequence_id"))
        .withColumn("tier", F.lit(LARGEST))
        .drop("_of")
    )
    whole = pieces.filter("sequence_id IS NOT NULL").unionByName(joined).drop("task")
    return whole.withColumnRenamed("key", key)
