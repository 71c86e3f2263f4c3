"""Vectorised words, word hashes and shingles over the UTF-8 bytes of many texts.

Every byte of a multi-byte character is at least 0x80, so a word class that takes
all characters beyond ASCII can be read byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Table of the bytes that belong to a word: all but the given ranges."""
    table = np.ones(256, bool)
    for first, last in ranges:
        table[first : last + 1] = False
    return table


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: [^\x20\x09-\x0D]+
NON_BLANK = _class([(0x20, 0x20), (0x09, 0x0D)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 20)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def chunks(texts: list[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``limit`` bytes (a longer text stands alone), with the first's place."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text or b"") > limit:
            yield first, [t or b"" for t in texts[first:i]]
            first, size = i, 0
        size += len(text or b"") + 1
    if first < len(texts):
        yield first, [t or b"" for t in texts[first:]]


@dataclass
class Words:
    """Words of some texts, in order.

    data: all bytes, lower-cased if asked for, a blank between texts.
    start, end: of each word in data; doc: its text; first: of each text, its first
    word (one more entry at the end); hash: 64 bits of each word.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def phrase(self, word: int, n: int) -> bytes:
        """``n`` words from ``word`` on, with one blank between them."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(word, word + n))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``n`` words from each word on, and whether they stay in one text."""
        size = max(0, len(self.hash) - n + 1)
        total = np.zeros(size, np.uint64)
        factor = 1
        for j in range(n):
            total += self.hash[j : j + size] * np.uint64(factor)
            factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        return mix(total), self.doc[:size] == self.doc[n - 1 : n - 1 + size]


def words_of(texts: list[bytes], table: np.ndarray, lower: bool) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    inside = table[data].view(np.int8)
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
    start, end = edges[0::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))
    hashes = mix((sums[end] - sums[start]) * down[start])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(start, bounds)
    return Words(data, start, end, np.repeat(np.arange(len(texts)), np.diff(first)), first, hashes)


class HashIndex:
    """Places of 64-bit values in a small set; a bit table spares most lookups."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(np.asarray(values, np.uint64))
        self.bits = max(10, min(24, 4 + int(np.ceil(np.log2(len(self.values) + 1)))))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.values >> np.uint64(64 - self.bits)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of values of the set, and their places in ``values``."""
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.bits)])
        if not len(maybe) or not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        same = self.values[place] == hashes[maybe]
        return maybe[same], place[same]
