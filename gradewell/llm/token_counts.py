"""Token counts without tokens: a byte-level BPE vocabulary compiled into deterministic transducers.

Two transducers run one after the other, and both write numbers on their transitions.

* **Cutting** (``CUT_NEXT``, ``CUT_MARKS``).  Reads character classes and marks where a piece starts.  The
  pre-tokenizer's one look-ahead, and its contractions, are states: a mark may belong to the character before.
  Texts are cut into chunks of equal length; every chunk is run from all states at once, which gives its *state map*
  (entry state to exit state).  Maps compose associatively, so a parallel prefix scan over them yields the entry state
  of each chunk, and a second run from there writes the marks.
* **Merging** (:class:`Merges`).  Reads the bytes of one piece and emits, on each transition, by how much the number
  of tokens changes.  The encoding of a prefix ends in exactly one token that agrees with the token before it, and
  a sequence of tokens is an encoding if and only if every two neighbours agree.  A state therefore needs, for every
  place where a longer token may still have begun, the position in the vocabulary's trie, the token that ends there
  and the count there relative to now.  States are made when a text first reaches them; all pieces start in
  the same state, so they advance in step, one byte a time, as numpy vectors.

Whole texts are counted; a piece of any length is one run of the transducer.  A task holds a bounded number of
characters at a time besides its largest text, and the tables are dropped when they exceed ``MAX_STATES``.

Results that are defined: a null or empty text has no bytes and no tokens; special strings inside a text count as
one token each, as the library does by default; repeated rows are counted alike; an empty table gives an empty
result.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, packed, unpacked

#: Characters handled together by a task.
BATCH_CHARS = 1 << 21
#: Characters of a chunk.
CHUNK = 256
#: Pieces beyond this many bytes are run one by one.
LONG_PIECE = 192
#: States of the merging transducer kept between batches.
MAX_STATES = 80_000
#: Rows by which the table of transitions grows.
ROWS_ADDED = 8_192
#: Below a trie node with at most so many tokens, a state keeps which of them may follow.
FEW_TOKENS = 16

# Character classes. QUOTE: apostrophe. STMD, E, L, RV: letters that may follow it in a contraction.
LETTER, STMD, E, L, RV, NUMBER, OTHER, QUOTE, SPACE, BLANK, END, UNKNOWN = range(12)
CLASSES = 11
#: White space of the pre-tokenizer besides the space itself (fixed values).
BLANKS = [
    *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
#: Stands between texts, where no character is.
SEPARATOR = 0x110000

# States of the cutting transducer: what the last character was. IN_QUOTE: an apostrophe that starts a piece;
# MAY_RE, MAY_LL: such an apostrophe and r or v, or l; DONE: a contraction has ended.
START, WORD, DIGITS, SIGNS, AFTER_SPACE, AFTER_BLANK, IN_QUOTE, MAY_RE, MAY_LL, DONE = range(10)
STATES = 10
#: Marks on a transition: a piece starts at this character, or at the one before.
HERE, BEFORE = 1, 2


def _cutting() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for every state and class."""
    letters = (LETTER, STMD, E, L, RV)
    follows = {WORD: letters, DIGITS: (NUMBER,), SIGNS: (OTHER, QUOTE), IN_QUOTE: (OTHER, QUOTE)}
    to = {**dict.fromkeys(letters, WORD), NUMBER: DIGITS, OTHER: SIGNS, QUOTE: IN_QUOTE, SPACE: AFTER_SPACE,
          BLANK: AFTER_BLANK, END: START}
    contraction = {STMD: DONE, L: MAY_LL, RV: MAY_RE}
    following = np.zeros((STATES, CLASSES), np.uint8)
    marks = np.zeros((STATES, CLASSES), np.uint8)
    for state in range(STATES):
        for kind in range(CLASSES):
            new, mark = to[kind], HERE
            if kind == END:
                mark = 0
            if state in (AFTER_SPACE, AFTER_BLANK):
                if kind in (SPACE, BLANK):
                    mark = 0  # the run goes on
                elif kind != END:
                    # the last blank leaves the run; a space joins what follows, another blank stays alone
                    mark = BEFORE if state == AFTER_SPACE else BEFORE | HERE
                    if state == AFTER_SPACE and kind == QUOTE:
                        new = SIGNS
            elif kind in follows.get(state, ()):
                new, mark = (SIGNS if state in (SIGNS, IN_QUOTE) else state), 0
            elif state == IN_QUOTE and kind in contraction:
                new, mark = contraction[kind], 0  # for MAY_RE and MAY_LL the next character tells
            elif (state, kind) in ((MAY_RE, E), (MAY_LL, L)):
                new, mark = DONE, 0
            elif state in (MAY_RE, MAY_LL):
                mark = (mark if kind not in letters else 0) | BEFORE  # no contraction: its letter began a word
            following[state, kind], marks[state, kind] = new, mark
    return following, marks


CUT_NEXT, CUT_MARKS = _cutting()


@cache
def _classes() -> np.ndarray:
    """Class of every code point; what this Python's Unicode tables leave unassigned is looked up when it occurs."""
    table = np.full(SEPARATOR + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for point in range(SEPARATOR):
        category = unicodedata.category(chr(point))
        if category == "Cn":
            table[point] = UNKNOWN
        elif category[0] in kinds:
            table[point] = kinds[category[0]]
    table[BLANKS] = BLANK
    for letters, kind in (("stmd", STMD), ("e", E), ("l", L), ("rv", RV), ("'", QUOTE), (" ", SPACE)):
        table[[ord(c) for c in letters]] = kind
    table[SEPARATOR] = END
    return table


def _look_up(points: np.ndarray) -> None:
    """Class of code points newer than this Python, as the library's own pre-tokenizer has them."""
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for point in points:
        character = chr(int(point))
        joined = (LETTER, "a"), (NUMBER, "1"), (OTHER, "!")
        _classes()[point] = next((k for k, beside in joined if len(cut(beside + character)) == 1), BLANK)


def state_maps(kinds: np.ndarray) -> np.ndarray:
    """Exit state of every chunk (row of classes) for each entry state."""
    flat = CUT_NEXT.ravel()
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(kinds), 1))
    for step in range(kinds.shape[1]):
        maps = flat[maps * np.uint8(CLASSES) + kinds[:, step, None]]
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each map with all before it, in a logarithmic number of rounds."""
    maps = maps.copy()
    shift = 1
    while shift < len(maps):
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift], axis=1)
        shift *= 2
    return maps


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Places in ``points`` (code points with separators) where a piece starts."""
    kinds = _classes()[points]
    if (unknown := kinds == UNKNOWN).any():
        _look_up(np.unique(points[unknown]))
        kinds = _classes()[points]
    chunks = -(-len(kinds) // CHUNK)
    rows = np.full(chunks * CHUNK, END, np.uint8)
    rows[: len(kinds)] = kinds
    rows = rows.reshape(chunks, CHUNK)
    entry = np.full(chunks, START, np.uint8)
    entry[1:] = prefix_scan(state_maps(rows))[:-1, START]
    marks = np.empty_like(rows)
    following, written = CUT_NEXT.ravel(), CUT_MARKS.ravel()
    state = entry
    for step in range(CHUNK):
        code = state * np.uint8(CLASSES) + rows[:, step]
        marks[:, step] = written[code]
        state = following[code]
    marks = marks.ravel()
    starts = (marks & HERE).astype(bool)
    starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts)


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Merges:
    """The merging transducer: states and transitions made on demand."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        letters = _byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.merged: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = vocab[a], vocab[b]
            self.merged.setdefault((left, right), rank)
            parts.setdefault(vocab[a + b], (left, right, rank))
        self.parts = parts
        #: Trie of the vocabulary: children by byte, the token that ends in a node, and the tokens below it as a range
        #: of places in byte order.
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.low: list[int] = [0]
        self.high: list[int] = [0]
        words = sorted((bytes(letters[c] for c in w), n) for w, n in vocab.items() if n in parts or len(w) == 1)
        self.in_order = [n for _, n in words]
        for place, (word, number) in enumerate(words):
            node = 0
            for byte in word:
                node = self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append(-1)
                    self.low.append(place)
                    self.high.append(place)
                self.high[node] = place + 1
            self.token[node] = number
        self.high[0] = len(words)
        self._spines: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next = np.full((ROWS_ADDED, 256), -1, np.int32)
        self.emits = np.zeros((ROWS_ADDED, 256), np.int16)
        self._masks: dict[tuple[int, int], int] = {}
        self._number(((0, -1, -1, 0),))
        self._spines.clear()

    def _number(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
            if number >= len(self.next):
                self.next = np.concatenate([self.next, np.full((ROWS_ADDED, 256), -1, np.int32)])
                self.emits = np.concatenate([self.emits, np.zeros((ROWS_ADDED, 256), np.int16)])
        return number

    def _spine(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """Parts of a token that touch its left (0) or right (1) end while it is merged: part, made at, used at."""
        key = token, side
        if key not in self._spines:
            found, used = [], float("inf")
            while token in self.parts:
                rank = self.parts[token][2]
                found.append((token, rank, used))
                token, used = self.parts[token][side], rank
            found.append((token, -1, used))
            self._spines[key] = found[::-1]
        return self._spines[key]

    def agree(self, a: int, b: int) -> bool:
        """Whether no merge ever crosses the border between two neighbouring tokens."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, made_x, used_x), (y, made_y, used_y) = left[i], right[j]
            rank = self.merged.get((x, y))
            # of equal merges the one further left comes first
            if rank is not None and max(made_x, made_y) < rank and rank < used_x and rank <= used_y:
                return False
            if used_x == used_y == float("inf"):
                return True
            if used_x <= used_y:
                i += 1
            else:
                j += 1

    def _open(self, node: int, before: int, mask: int) -> tuple[int, int, int] | None:
        """What a state keeps of a place where a longer token may have begun; None if none can.

        Below a node with few tokens the token before the place is replaced by the tokens it agrees with, one bit
        each: prefixes that differ only in what cannot matter any more then share a state.
        """
        low, size = self.low[node], self.high[node] - self.low[node]
        if mask < 0 and size <= FEW_TOKENS:
            key = node, before
            mask = self._masks.get(key, -1)
            if mask < 0:
                mask = 0
                for k, token in enumerate(self.in_order[low : low + size]):
                    if before < 0 or self.agree(before, token):
                        mask |= 1 << k
                self._masks[key] = mask
        if mask < 0:
            return node, before, -1
        if self.token[node] >= 0:
            mask &= ~1  # the node's own token comes first in its range; it is no longer one
        return (node, -1, mask) if mask else None

    def make(self, number: int, byte: int) -> tuple[int, int]:
        """Make a transition: the state it leads to and the change in the number of tokens."""
        places, last, change = [], None, 0
        for node, before, mask, count in self.states[number]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            if mask >= 0:
                mask = mask >> (self.low[child] - self.low[node]) & (1 << (self.high[child] - self.low[child])) - 1
            token = self.token[child]
            if token >= 0 and last is None:
                if mask & 1 if mask >= 0 else before < 0 or self.agree(before, token):
                    last, change = token, count + 1
            if self.children[child] and (place := self._open(child, before, mask)):
                places.append((*place, count))
        state = (*((*place, count - change) for *place, count in places), (0, last, -1, 0))
        to = self._number(state)
        self.next[number, byte], self.emits[number, byte] = to, change
        return to, change

    def count(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of every piece ``data[start : start + length]``."""
        totals = np.zeros(len(starts), np.int64)
        order = np.argsort(-np.minimum(lengths, 30_000).astype(np.int16), kind="stable")
        starts, lengths = starts[order], lengths[order]
        longer = int(np.searchsorted(-lengths, -LONG_PIECE, side="left"))
        for k in range(longer):
            totals[k] = self._count_one(data[starts[k] : starts[k] + lengths[k]].tolist())
        at, size = starts[longer:], lengths[longer:]
        found, state = np.zeros(len(at), np.int64), np.zeros(len(at), np.int32)
        active = len(at)
        for step in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size[:active], -step, side="left"))
            code = state[:active].astype(np.int64) * 256 + data[at[:active] + step]
            to = self.next.ravel()[code]
            if (to < 0).any():
                for new in np.unique(code[to < 0]).tolist():
                    self.make(new >> 8, new & 255)
                to = self.next.ravel()[code]
            found[:active] += self.emits.ravel()[code]
            state[:active] = to
        totals[longer:] = found
        result = np.empty_like(totals)
        result[order] = totals
        return result

    def _count_one(self, piece: list[int]) -> int:
        state = total = 0
        known: dict[int, tuple[int, int]] = {}
        for byte in piece:
            code = state << 8 | byte
            if code not in known:
                to = int(self.next[state, byte])
                known[code] = self.make(state, byte) if to < 0 else (to, int(self.emits[state, byte]))
            state, change = known[code]
            total += change
        return total


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec["pre_tokenizer"]
        known = cutter["type"] == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] is not None or not known:
            raise ValueError("only plain byte-level BPE vocabularies are compiled")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])

    def _segments(self, text: str) -> list[str]:
        """The text between special strings; there is one such string less than segments."""
        parts = [text]
        for special in sorted(self.special, key=len, reverse=True):
            if special in text:
                parts = [s for p in parts for s in p.split(special)]
        return parts

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text, a bounded number of characters at a time."""
        result = np.zeros(len(texts), np.int64)
        first, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text) + 1
            if size >= BATCH_CHARS or k == len(texts) - 1:
                result[first : k + 1] = self._count(texts[first : k + 1])
                first, size = k + 1, 0
        return result

    def _count(self, texts: list[str]) -> np.ndarray:
        if len(self.merges.states) > MAX_STATES:
            self.merges.clear()
        split = [self._segments(t) for t in texts]
        segments = [s for parts in split for s in parts]
        owner = np.repeat(np.arange(len(texts)), [len(parts) for parts in split])
        sizes = np.array([len(s) for s in segments], np.int64)
        ends = np.cumsum(sizes + 1)  # one separator after each
        points = np.full(int(ends[-1]), SEPARATOR, np.uint32)
        keep = np.ones(len(points), bool)
        keep[ends - 1] = False
        joined = "".join(segments)
        points[keep] = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        width = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += points >= least
        width[ends - 1] = 0
        offsets = np.cumsum(width, dtype=np.int64) - width
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        marked = piece_starts(points)
        starts = offsets[marked]
        lengths = np.diff(starts, append=len(data))
        tokens = self.merges.count(data, starts, lengths)
        by_segment = np.bincount(np.searchsorted(ends, marked, side="right"), weights=tokens, minlength=len(segments))
        totals = np.bincount(owner, weights=by_segment, minlength=len(texts)).astype(np.int64)
        return totals + np.array([len(parts) - 1 for parts in split], np.int64)


@cache
def counter(vocabulary: str) -> Counter:
    """One compiled vocabulary per worker process; a bare file name is one of the installed public vocabularies."""
    if "/" not in vocabulary:
        import public_tokenizers

        vocabulary = str(public_tokenizers.path(vocabulary))
    return Counter(vocabulary)


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int, text: str = "text"
) -> DataFrame:
    """The input columns, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens)."""

    @F.pandas_udf("bigint")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled = counter(vocabulary)
        for texts in batches:
            yield pd.Series(compiled.count(texts.tolist()))

    read = F.coalesce(field(text), F.lit(""))
    counted = packed(docs).withColumns({"n_bytes": F.octet_length(read).cast("bigint"), "n_tokens": tokens(read)})
    return unpacked(counted.withColumn("over_limit", F.col("n_tokens") > limit), "n_bytes", "n_tokens", "over_limit")
