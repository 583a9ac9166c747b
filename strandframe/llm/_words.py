"""Words of Arrow text columns as 64-bit hashes, computed on the raw UTF-8 bytes.

A word is a longest run of bytes outside ``\\x20 \\x09-\\x0D`` (with
``punctuation=True`` ASCII punctuation separates too), A-Z lower-cased. Its
hash is a polynomial over random byte values modulo 2**64, finished with a
bijective mixer: prefix sums give every word of a slice at once, so no Python
code runs per word. Words of more than ``LONGEST`` bytes, for which such a polynomial
can be made to collide, are rare and hashed by BLAKE2b one by one. Texts are worked off in slices of about ``SLICE`` bytes
that always hold whole texts, which bounds the memory by the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
LONGEST = 32
_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_VALUES = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
for _c in range(65, 91):
    _VALUES[_c] = _VALUES[_c + 32]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PUNCT = _BLANK.copy()
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _PUNCT[_c] = True
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_PRIME, _INVERSE)):
            p = np.full(n, base, _U)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """The words of the rows first..last of a column."""

    first: int
    last: int
    hashes: np.ndarray  # uint64, one per word
    bounds: np.ndarray  # int64, last - first + 1 offsets into hashes
    tails: np.ndarray  # uint8, the last byte of each word, lower-cased

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def word_slices(column: pa.Array, punctuation: bool = False) -> Iterator[Words]:
    """The words of a column, slice after slice; every row is in one slice."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    blank = _PUNCT if punctuation else _BLANK
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        if last == first + 1 and offsets[last] - offsets[first] > SLICE:
            yield _long(data[offsets[first] : offsets[last]], first, blank)
        else:
            yield _slice(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last, blank)
        first = last


def _slice(raw: np.ndarray, offsets: np.ndarray, first: int, last: int, blank: np.ndarray) -> Words:
    n = len(raw)
    if not n:
        return Words(first, last, np.zeros(0, _U), np.zeros(last - first + 1, np.int64), np.zeros(0, np.uint8))
    power, inverse = _power_tables(n + 1)
    inside = ~blank[raw]
    begins, ends = inside.copy(), np.zeros(n + 1, bool)
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[1:n] = inside[:-1] & ~inside[1:]
    ends[edges] |= inside[edges - 1]
    ends[n] = inside[-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_VALUES[raw] * power[:n], out=sums[1:])
    hashes = mix64((sums[stop] - sums[start]) * inverse[start])
    for k in np.flatnonzero(stop - start > LONGEST).tolist():
        hashes[k] = _digest(raw[start[k] : stop[k]])
    return Words(first, last, hashes, np.searchsorted(start, offsets), _LOWER[raw[stop - 1]])


def _long(raw: np.ndarray, first: int, blank: np.ndarray) -> Words:
    """The words of one long row, read in parts that end at blanks; what a part needs beside its words is freed after it."""
    parts, at, n = [], 0, len(raw)
    while at < n:
        end = stop = min(n, at + SLICE)
        while stop < n:
            some = np.flatnonzero(blank[raw[stop : stop + SLICE]])
            stop += int(some[0]) if len(some) else min(SLICE, n - stop)
            if len(some):
                break
        if stop - end > LONGEST:
            some = np.flatnonzero(blank[raw[at:end]])
            cut = at + int(some[-1]) + 1 if len(some) else at
            parts += [_slice(raw[at:cut], np.array([0, cut - at]), 0, 1, blank), _one(raw[cut:stop])]
        else:
            parts.append(_slice(raw[at:stop], np.array([0, stop - at]), 0, 1, blank))
        at = stop
    hashes = np.concatenate([p.hashes for p in parts])
    return Words(first, first + 1, hashes, np.array([0, len(hashes)]), np.concatenate([p.tails for p in parts]))


def _digest(word: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(_LOWER[word].tobytes(), digest_size=8).digest(), "little")


def _one(word: np.ndarray) -> Words:
    """A row that is one word longer than LONGEST."""
    return Words(0, 1, np.array([_digest(word)], _U), np.array([0, 1]), _LOWER[word[-1:]])


def word_hashes(text: str, punctuation: bool = False) -> np.ndarray:
    """The words of one text."""
    return np.concatenate([w.hashes for w in word_slices(pa.array([text]), punctuation)] or [np.zeros(0, _U)])
