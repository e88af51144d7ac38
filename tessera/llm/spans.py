"""Hashes of word spans: one pass of numpy over the bytes of many texts.

A text's words stand in one buffer, parted by single spaces, so the hash of any run of words is the difference of two
prefix sums of byte values times powers of an odd base, shifted back by the inverse power (all modulo 2**64). Such hashes only
deal rows and look pieces up: different words may share one, so equality is told by other means.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64
#: Words that are hashed at once; longer texts are taken in pieces that overlap.
PIECE_WORDS = 50_000
PIECE_BYTES = 1 << 19


@lru_cache(maxsize=4)
def _base(which: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(977 + which)
    table = rng.integers(0, 2**64, 256, dtype=_U)
    base = int(rng.integers(0, 2**63, dtype=_U)) * 2 + 1
    return table, base, pow(base, -1, 2**64)


_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """At least the first n powers of base modulo 2**64; one table a base is kept, the longest asked for."""
    if base not in _tables or len(_tables[base]) < n:
        out = np.ones(1 << max(16, n.bit_length()), _U)
        out[1:] = _U(base)
        _tables[base] = np.multiply.accumulate(out)
    return _tables[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of some byte lines: line(i) owns words first[i] to first[i + 1] - 1."""

    def __init__(self, lines: list[list[bytes]]):
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
        self.line = b" ".join([w for x in lines for w in x] + [b""])
        self.bytes = np.frombuffer(self.line, np.uint8)
        self.ends = np.flatnonzero(self.bytes == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self._sums: dict[int, np.ndarray] = {}

    def span(self, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
        """The hash of words a to b, both included."""
        size = len(self.bytes)
        bytes_, base, back = _base(which)
        if which not in self._sums:
            values = bytes_[self.bytes] * powers(base, size)[:size]
            self._sums[which] = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
        sums, s, e = self._sums[which], self.starts[a], self.ends[b]
        return mix((sums[e] - sums[s]) * powers(back, size)[s])


def pieces(texts: list[str | None], overlap: int):
    """Yields (rows, offsets, Words): row i of rows is a text, or the part of it that begins at word offsets[i].

    Parts of one text overlap by the given number of words.
    """
    rows, offsets, lines, load = [], [], [], 0
    for row, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        for at in range(0, max(len(words) - overlap, 1), PIECE_WORDS):
            part = words[at : at + PIECE_WORDS + overlap]
            rows.append(row)
            offsets.append(at)
            lines.append(part)
            load += sum(map(len, part)) + len(part)
            if load > PIECE_BYTES:
                yield np.array(rows), np.array(offsets), Words(lines)
                rows, offsets, lines, load = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(offsets), Words(lines)
