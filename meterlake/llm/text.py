"""Vectorised text work on Arrow buffers: words, word hashes and shingles of many texts at once, without Python strings.

Texts arrive as Arrow arrays and are cut into slices of whole rows of about ``SLICE_BYTES``; a longer text is a slice of its
own, and every pass over bytes inside it works in bounded steps.  Identities are 64-bit hashes that depend on the bytes
alone, so that they agree between tasks, runs and machines.  A null text is an empty text here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
STEP_BYTES = 1 << 17

# The two word definitions of the contracts, as tables over bytes.  Bytes from 0x80 on belong to letters beyond ASCII.
_BYTES = np.arange(256)
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LETTER_DIGIT = (
    (_BYTES >= 0x80)
    | ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
)

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
    values[0x41:0x5B] = values[0x61:0x7B]  # A-Z count as a-z
    return values


_VALUES = _byte_values()


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the multiplier and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, STEP_BYTES + 1024)
            self.up, self.down = _geometric(_MULTIPLIER, size), _geometric(_INVERSE, size)
        return self.up, self.down


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the multiplier and of its inverse, for values of stretches."""
    return _POWERS.upto(n)


@dataclass
class Slice:
    """Some whole rows of a batch: ``offsets[i]:offsets[i + 1]`` are the bytes of row ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "surrogatepass")


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a batch of texts into slices of whole rows, balanced by bytes."""
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1))
        yield Slice(lo, whole[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


@dataclass
class Words:
    """Byte ranges of the words of a slice; the words of row i are ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words(part: Slice, is_word: np.ndarray) -> Words:
    inside = is_word[part.data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = part.offsets[:-1][np.diff(part.offsets) > 0]  # no word goes over the edge of a row
    begin[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    end[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, part.offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit value per word, blind to the case of A-Z."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + STEP_BYTES, "right")))
        stop = int(ends[j - 1])
        up, down = _POWERS.upto(stop - base)
        total = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(_VALUES[data[base:stop]] * up[: stop - base], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _LENGTH
        i = j
    return mix(out)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Values of all runs of k consecutive words; runs over row edges are the caller's to skip."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _SHINGLE
        out += hashes[j : j + n]
    return mix(out)


def whole(hashes: np.ndarray) -> np.uint64:
    """The value of a sequence shorter than a shingle."""
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = out * _SHINGLE + h
        return mix(np.array([out + np.uint64(len(hashes)) * _LENGTH]))[0]


def shingle_sets(texts: pa.Array, k: int, is_word: np.ndarray = NOT_SPACE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle values) of every text; a text of fewer than k words is one shingle."""
    for part in slices(texts):
        found = words(part, is_word)
        hashes = word_hashes(part.data, found.starts, found.ends)
        runs = rolling(hashes, k)
        for i in range(len(part)):
            lo, hi = found.first[i], found.first[i + 1]
            if hi - lo >= k:
                yield part.first + i, np.unique(runs[lo : hi - k + 1])
            elif hi > lo:
                yield part.first + i, np.array([whole(hashes[lo:hi])])
            else:
                yield part.first + i, np.zeros(0, np.uint64)
