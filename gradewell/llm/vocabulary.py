"""Where the vocabulary files of public tokenizers are."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager


def path(name: str) -> str:
    """A vocabulary file; a bare name is one of the installed public ones."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 ones stand for themselves, the
    others in order for characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: How a byte-level vocabulary writes the characters up to U+00FF, for ``str.translate``.
SPELLED = (lambda written: {c: "".join(written[b] for b in chr(c).encode()) for c in range(256)})(
    {b: c for c, b in byte_alphabet().items()}
)


@contextmanager
def no_cycles() -> Iterator[None]:
    """No search for cycles while millions of small results are made, none of which is in one."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Recent:
    """Results for the words met last, a bounded number of them.

    Two generations: words go to the newer one, whose place the older one gives up when it is full, so words that come
    again and again stay while those met once go.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], most: int) -> None:
        self.make, self.half = make, most // 2
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def each(self, lists: list[list[str]]) -> Iterator[list]:
        """For every list the results of its words; ``make`` gives those of all new words at once."""
        found = [list(map(self.new.get, words)) for words in lists]
        missing = {w for words, values in zip(lists, found) if None in values for w, v in zip(words, values) if v is None}
        before = {w: v for w in missing if (v := self.old.get(w)) is not None} if self.old else {}
        if len(self.new) + len(missing) > self.half:
            self.old, self.new = self.new, {}
        known = self.new if len(missing) <= self.half else {}
        known.update(before)
        fresh = [w for w in missing if w not in before] if before else list(missing)
        known.update(zip(fresh, self.make(fresh)))
        for words, values in zip(lists, found):
            yield [known[w] if v is None else v for w, v in zip(words, values)] if None in values else values


def slices(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer one alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
