"""Token counts of whole texts by a public tokenizer, in Arrow batches that return lengths only.

A batch is cut into slices balanced by bytes, and texts are split at safe boundaries: before a single space that has a visible
character on either side.  No pre-token of a byte-level vocabulary goes over such a place, and no special string holds a
space, so the counts of the pieces add up to the count of the text, however long it is.  Equal pieces (by a 64-bit value of
their bytes) are encoded once per task and remembered within a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.llm.text import _INVERSE, _MULTIPLIER, SLICE_BYTES, STEP_BYTES, _geometric, mix, slices

REMEMBERED = 1_000_000  # pieces whose count a task keeps: 16 bytes each


def _piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places where pieces begin: rows, and single spaces between visible characters."""
    space = np.flatnonzero(data == 0x20)
    space = space[(space > 1) & (space < len(data) - 1)]
    before, after, third = data[space - 1], data[space + 1], data[space - 2]
    # Two-byte letters from U+00C0 on are no white space; other bytes beyond ASCII are left alone.
    visible_before = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (third >= 0xC3) & (third <= 0xDF))
    visible_after = ((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after <= 0xDF))
    rows = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(rows, space[visible_before & visible_after])


def _piece_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value of the bytes of each piece, computed in bounded steps."""
    out = np.empty(len(starts), np.uint64)
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_INVERSE))
    up = down = np.zeros(0, np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + STEP_BYTES, "right")))
        stop = int(ends[j - 1])
        if stop - base > len(up):
            up, down = (_geometric(b, max(stop - base, STEP_BYTES)) for b in (_MULTIPLIER, _INVERSE))
        total = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(table[data[base:stop]] * up[: stop - base], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        # At the last place there is no power left, but no piece begins there.
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


class _Counter:
    """Token counts of pieces; remembers them by value, oldest half forgotten when full."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode_batch_fast
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Counts per row of a slice."""
        starts = _piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], offsets[-1])
        values, first, which = np.unique(_piece_values(data, starts, ends), return_index=True, return_inverse=True)
        counts = np.zeros(len(values), np.int32)
        row = np.minimum(np.searchsorted(self.values, values), max(0, len(self.values) - 1))
        known = self.values[row] == values if len(self.values) else np.zeros(len(values), bool)
        counts[known] = self.counts[row[known]]
        new = np.flatnonzero(~known)
        pieces = [data[starts[k] : ends[k]].tobytes().decode("utf-8", "replace") for k in first[new]]
        counts[new] = [len(e) for e in self.encode(pieces, add_special_tokens=False)]
        self.remember(values[new], counts[new])
        total = np.concatenate([[0], np.cumsum(counts[which].astype(np.int64))])
        return np.diff(total[np.searchsorted(starts, offsets)])

    def remember(self, values: np.ndarray, counts: np.ndarray) -> None:
        if len(self.values) + len(values) > REMEMBERED:
            self.values, self.counts = self.values[::2], self.counts[::2]
        values, counts = np.concatenate([self.values, values]), np.concatenate([self.counts, counts])
        order = np.argsort(values)
        self.values, self.counts = values[order][:REMEMBERED], counts[order][:REMEMBERED]


def token_counts(text: Column | str, tokenizer: str) -> Column:
    """struct<n_bytes, n_tokens> of whole texts (null: an empty text, no tokens).

    tokenizer: path of a byte-level .json vocabulary, readable on every executor.  No special tokens are added; special strings
    inside a text are handled as the library does by default; nothing is truncated.
    """

    @F.arrow_udf("struct<n_bytes:bigint,n_tokens:bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = _Counter(tokenizer)
        for texts in batches:
            parts = list(slices(texts, SLICE_BYTES))
            n_bytes = np.concatenate([np.diff(p.offsets) for p in parts]) if parts else np.zeros(0, np.int64)
            n_tokens = np.concatenate([counter(p.data, p.offsets) for p in parts]) if parts else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays([pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["n_bytes", "n_tokens"])

    return count(text)
