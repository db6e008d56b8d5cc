"""Vectorised helpers over Arrow text batches (numpy, used inside tasks).

A batch of texts is one byte buffer plus row offsets; the helpers find the
words of all rows at once and hash them, so no Python code runs per word.
Rows are handled in blocks of about ``BLOCK_BYTES``, and a single long text in
pieces of that size, so memory does not grow with the batch or the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is an empty row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each (a longer row is alone in its range)."""
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end
        at = end


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, _BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def runs(mask: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal true runs; a row start also cuts a run."""
    n = len(mask)
    cut = np.zeros(n + 1, bool)
    cut[row_starts] = True
    cut[0] = cut[n] = True
    begins = mask.copy()
    begins[1:] &= ~mask[:-1] | cut[1:n]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are sorted and do not overlap.

    Polynomial prefix sums, taken piecewise so that the tables stay small; a
    piece ends at a span end (a single longer span makes its piece longer).
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        end = int(np.searchsorted(ends, base + BLOCK_BYTES, side="right"))
        end = max(end, at + 1)
        lo, hi = starts[at:end] - base, ends[at:end] - base
        piece = data[base:ends[end - 1]]
        up, down = _power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:len(piece)], out=sums[1:])
        out[at:end] = mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))
        at = end
    return out


def span_hash_raw(data: np.ndarray) -> np.uint64:
    """The unmixed polynomial of one byte span (what prefix sums give for it)."""
    up, _ = _power_tables(len(data) + 1)
    return ((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)]).sum(dtype=np.uint64)


def word_rows(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of every row, plus the number of words."""
    return np.searchsorted(starts, offsets, side="left")


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (len - k + 1 values)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h *= np.uint64(_BASE)
        h += words[j:j + n]
    return mix(h)
