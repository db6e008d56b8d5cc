"""Hashed n-gram indicators of whole texts, and the bounded labelled sample.

A token is a run of letters, of digits, or of other signs. Two streams are
read off the tokens: the words (lower-cased bytes) and their shapes (lower,
Capital, UPPER, number, or the signs themselves, and whether a space comes
first). Features are word n-grams, shape n-grams and word repeats, hashed
into ``DIMENSIONS`` indicators: a feature is in a text or not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import arrays

DIMENSIONS = 1 << 20
_SHIFT = np.uint64(64 - 20)
#: At most so many labelled rows are fitted (the first in the order of a hash of their id).
MAX_LABELLED = 6_000
HOLDOUT_FOLDS = 5
PREFIX_BYTES = (4, 5, 6, 7)

_CLASS = np.full(256, 3, np.uint8)
_CLASS[arrays.SPACES] = 0
_CLASS[0x00] = 0
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0x80:] = 1
_CLASS[0x30:0x3A] = 2
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True


class Tokens:
    """Tokens of a block of texts: ``words`` and ``shapes`` (hashes), ``rows`` (row of each)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shapes: bool = True):
        kind = _CLASS[data]
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[offsets[:-1]] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        inked = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
        starts, ends = starts[inked], ends[inked]
        self.words = arrays.span_hashes(arrays.ASCII_LOWER[data], starts, ends)
        self.first = arrays.word_rows(starts, offsets)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._spans = starts, ends
        self._data = data
        if shapes and len(starts):
            self.shapes = self._shapes(data, kind, starts, ends)

    def _shapes(self, data, kind, starts, ends) -> np.ndarray:
        upper = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int32)])
        lower = np.concatenate([[0], np.cumsum(_LOWER[data], dtype=np.int32)])
        many = upper[ends] - upper[starts]
        shape = np.where(many == 0, 1, np.where((many > 1) & (lower[ends] == lower[starts]), 3, 2)).astype(np.uint64)
        shape[kind[starts] == 2] = 4
        signs = kind[starts] == 3
        shape[signs] = self.words[signs]
        before = np.zeros(len(starts), bool)
        before[1:] = starts[1:] == ends[:-1]
        return arrays.mix(shape * np.uint64(2) + before.astype(np.uint64))

    def prefixes(self, size: int, salt: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of the first ``size`` bytes of longer tokens (``skip``: flags of tokens left out)."""
        starts, ends = self._spans
        longer = ends - starts > size
        if skip is not None:
            longer &= ~skip
        starts = starts[longer]
        hashes = arrays.span_hashes(arrays.ASCII_LOWER[self._data], starts, starts + size) + np.uint64(salt)
        return self.rows[longer], feature(hashes)

    def ngrams(self, stream: np.ndarray, k: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of the k-grams of a stream that lie inside a row."""
        if len(stream) < k:
            return self.rows[:0], np.zeros(0, np.int64)
        inside = self.rows[k - 1:] == self.rows[:len(stream) - k + 1]
        hashes = arrays.gram_hashes(stream, k) + np.uint64(salt)
        return self.rows[:len(stream) - k + 1][inside], feature(hashes[inside])


def feature(hashes: np.ndarray) -> np.ndarray:
    return (arrays.mix(hashes) >> _SHIFT).astype(np.int64)


def word_features(tokens: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word unigrams and bigrams."""
    return [tokens.ngrams(tokens.words, 1, 1), tokens.ngrams(tokens.words, 2, 2)]


def stem_features(tokens: Tokens, skip: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word unigrams and bigrams, and the beginnings of longer words (inflected and compound forms)."""
    return word_features(tokens) + [tokens.prefixes(size, 20 + size, skip) for size in PREFIX_BYTES]


def style_features(tokens: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word n-grams, shape n-grams, and a word repeated at once (and how often, as powers of two)."""
    out = word_features(tokens)
    if not len(tokens.words):
        return out
    out += [tokens.ngrams(tokens.shapes, 2, 3), tokens.ngrams(tokens.shapes, 3, 4)]
    again = np.zeros(len(tokens.words), bool)
    again[1:] = (tokens.words[1:] == tokens.words[:-1]) & (tokens.rows[1:] == tokens.rows[:-1])
    counts = np.bincount(tokens.rows[again], minlength=len(tokens.first) - 1)
    row = np.flatnonzero(counts)
    for level in range(0, 8, 2):
        out.append((row[counts[row] >= 1 << level], np.full((counts[row] >= 1 << level).sum(), feature(np.array([5 + level], np.uint64))[0])))
    return out


def distinct(parts: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray | None = None):
    """(row, feature) pairs, once each, sorted by row; only ``wanted`` features if given."""
    keys = []
    for row, f in parts:
        if wanted is not None:
            keep = wanted[f]
            row, f = row[keep], f[keep]
        keys.append(row * DIMENSIONS + f)
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return keys // DIMENSIONS, keys % DIMENSIONS


def indicators(texts: pa.Array, extract, shapes: bool) -> pa.Array:
    """Sorted distinct features of each text as a list."""
    data, offsets = arrays.text_buffer(texts)
    values, counts = [np.zeros(0, np.int64)], []
    for first, last in arrays.blocks(offsets):
        tokens = Tokens(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], shapes)
        row, f = distinct(extract(tokens))
        values.append(f)
        counts.append(np.bincount(row, minlength=last - first))
    ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), pa.int32()))


def linear_margins(texts: pa.Array, weights: np.ndarray, bias: float, extract, shapes: bool) -> np.ndarray:
    """``bias`` plus the weights of the features in each text."""
    data, offsets = arrays.text_buffer(texts)
    wanted = weights != 0
    out = np.full(len(offsets) - 1, bias, np.float64)
    for first, last in arrays.blocks(offsets):
        tokens = Tokens(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], shapes)
        row, f = distinct(extract(tokens), wanted)
        out[first:last] += np.bincount(row, weights[f], last - first)
    return out


def fold(id_col):
    """crc32 of the id as text, modulo five; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HOLDOUT_FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                    max_rows: int = MAX_LABELLED) -> DataFrame:
    """(id, label, text) of at most ``max_rows`` labelled rows outside fold 0, one per id.

    The ids are chosen from the narrow label table alone (at most ``max_rows``
    of them, hence the broadcast); of several labels or texts of an id the
    smallest counts.
    """
    ids = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 0))
    ids = ids.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # one id may stand on very many rows: a partial aggregate before the shuffle
    return texts.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
