"""Benchmark decontamination by winnowing.

Method. Texts become word sequences; every run of ``GRAM_WORDS`` words is
hashed, and of each window of ``WINDOW_GRAMS`` consecutive hashes the
smallest (leftmost) is kept as a fingerprint. A shared span of
``SPAN_WORDS = GRAM_WORDS + WINDOW_GRAMS - 1`` words contains one whole window
on both sides and therefore one common fingerprint: no such span is missed.
The fingerprints of documents and benchmark are joined; every hit is extended to the 13-word windows
around it in its document, and these are joined with the benchmark's windows by two
independent 64-bit hashes of their words. Items shorter than a span are one window of their own
length, whose hash is their fingerprint; documents then also have one of each run of that length.

Both sides are tables of any size. Documents are known by a 128-bit hash of their text. What has a hit is
written before it is joined with the documents, so that the planner knows its size: the texts
cross a shuffle only if the hits are too many to broadcast. Frequent fingerprints, windows and texts are
keys of joins that adaptive execution can split (``tables.split_join``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm import arrays
from threadsift.llm.tables import split_join, temporary_name, written

SPAN_WORDS = 13
GRAM_WORDS = 5
WINDOW_GRAMS = SPAN_WORDS - GRAM_WORDS + 1

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Tells the second hash of a window, and the hashes of each short length, from the first.
_SECOND = np.uint64(0xD6E8FEB86659FD93)

WINDOW = "struct<start: bigint, n: int, key1: bigint, key2: bigint>"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each row's first word and the total)."""
    starts, ends = arrays.runs(WORD[data], offsets[:-1])
    return arrays.span_hashes(arrays.ASCII_LOWER[data], starts, ends), arrays.word_rows(starts, offsets)


def winnow(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the fingerprints; ``rows`` are first words of rows and the total.

    Grams across rows never count; a row of at least a span keeps the
    smallest gram of each of its windows.
    """
    grams = arrays.gram_hashes(words, GRAM_WORDS)
    n = len(grams) - WINDOW_GRAMS + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = rows[1:-1]
    for back in range(1, GRAM_WORDS):  # grams that run over a row's end
        at = inner - back
        grams[at[(at >= 0) & (at < len(grams))]] = _NONE
    best = grams[:n].copy()
    offset = np.zeros(n, np.int8)
    for j in range(1, WINDOW_GRAMS):
        other = grams[j:n + j]
        less = other < best
        np.copyto(best, other, where=less)
        offset[less] = j
    chosen = np.zeros(len(grams), bool)
    chosen[np.arange(n) + offset] = True
    chosen &= grams != _NONE
    at = np.flatnonzero(chosen)
    return at, grams[at]


def _short_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of each run of ``length`` words, for items of that length."""
    return arrays.mix(arrays.gram_hashes(words, length) ^ _SECOND * np.uint64(length))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def fingerprints(texts: pa.Array, lengths: list[int], whole: bool) -> pa.Array:
    """Per text: its winnowed hashes, and those of its runs of each length in ``lengths``.

    ``whole``: texts are items, so only one of exactly that length has such a run, and no shorter one winnowed hashes.
    """
    data, offsets = arrays.text_buffer(texts)
    rows_of, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, last in arrays.blocks(offsets):
        words, rows = _words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        size = np.diff(rows)
        at, grams = winnow(words, rows)
        long = size[row[at]] >= SPAN_WORDS
        rows_of.append(row[at[long]] + first)
        values.append(grams[long])
        for length in lengths:
            starts = np.arange(max(0, len(words) - length + 1))
            fits = starts + length <= rows[1:][row[starts]]
            if whole:
                fits &= size[row[starts]] == length
            rows_of.append(row[starts[fits]] + first)
            values.append(_short_hashes(words, length)[fits])
    rows_of, values = np.concatenate(rows_of), np.concatenate(values)
    order = np.argsort(rows_of, kind="stable")
    ends = np.searchsorted(rows_of[order], np.arange(len(offsets)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(values[order]))


def _windows(words: np.ndarray, starts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """(start, length, first hash, second hash) of the windows at the given (length, starts)."""
    again = arrays.mix(words ^ _SECOND)
    parts = [(at, np.full(len(at), n, np.int32), _hash_at(words, at, n), _hash_at(again, at, n)) for n, at in starts]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _window_lists(found: list[tuple[np.ndarray, ...] | None]) -> pa.Array:
    some = [f for f in found if f is not None] or [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    start, n, key1, key2 = (np.concatenate(x) for x in zip(*some))
    ends = np.cumsum([0, *(0 if f is None else len(f[0]) for f in found)]).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(n), _signed(key1), _signed(key2)],
                                      ["start", "n", "key1", "key2"])
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _each(texts: pa.Array):
    """The word hashes of each text."""
    data, offsets = arrays.text_buffer(texts)
    for first, last in arrays.blocks(offsets):
        words, rows = _words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        for r in range(len(rows) - 1):
            yield words[rows[r]:rows[r + 1]]


def item_windows(texts: pa.Array) -> pa.Array:
    """All windows of each item."""
    return _window_lists([_windows(w, [(n, np.arange(len(w) - n + 1))]) if (n := min(len(w), SPAN_WORDS)) else None
                          for w in _each(texts)])


def near_windows(texts: pa.Array, hits: pa.Array, lengths: list[int]) -> pa.Array:
    """The windows of each text that hold one of its hit fingerprints."""
    found = []
    for words, keys in zip(_each(texts), hits):
        keys = np.array(keys.values, np.int64).view(np.uint64)
        starts = []
        if len(words) >= SPAN_WORDS:
            at, grams = winnow(words, np.array([0, len(words)]))
            at = at[np.isin(grams, keys)]
            near = np.zeros(len(words) + 1, np.int64)
            np.add.at(near, np.maximum(at - (SPAN_WORDS - GRAM_WORDS), 0), 1)
            np.add.at(near, at + 1, -1)
            at = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            starts.append((SPAN_WORDS, at[at + SPAN_WORDS <= len(words)]))
        starts += [(n, np.flatnonzero(np.isin(_short_hashes(words, n), keys))) for n in lengths]
        found.append(_windows(words, starts) if starts else None)
    return _window_lists(found)


def _hash_at(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """``gram_hashes`` at the given starts only."""
    h = np.zeros(len(at), np.uint64)
    for j in range(length):
        h *= np.uint64(arrays._BASE)
        h += words[at + j]
    return arrays.mix(h)


def word_counts(texts: pa.Array) -> pa.Array:
    data, offsets = arrays.text_buffer(texts)
    counts = [np.zeros(0, np.int64)]
    for first, last in arrays.blocks(offsets):
        part = data[offsets[first]:offsets[last]]
        starts, _ = arrays.runs(WORD[part], offsets[first:last] - offsets[first])
        counts.append(np.diff(arrays.word_rows(starts, offsets[first:last + 1] - offsets[first])))
    return pa.array(np.concatenate(counts).astype(np.int64))


def covered(spans: Column) -> Column:
    """Number of words in a sorted array of (start, end) spans, overlaps once."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["reach"], s["start"]))).alias("n"),
        F.greatest(a["reach"], s["end"]).alias("reach"))
    return F.aggregate(spans, zero, step, lambda a: a["n"])


def _benchmark_tables(benchmark: DataFrame, item_id_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct fingerprints ``h``, windows ``n, key1, key2`` with their sorted item ids, and the lengths of short items."""
    items = benchmark.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("id"), F.col(item_text_col).alias("text"))
    items = items.where("text is not null").distinct()
    words = F.arrow_udf(word_counts, "bigint")
    # at most SPAN_WORDS - 1 numbers
    lengths = items.select(words("text").cast("int").alias("n")).where(f"n > 0 and n < {SPAN_WORDS}").agg(F.collect_set("n")).first()[0]
    hashes = F.arrow_udf(lambda texts: fingerprints(texts, lengths, True), "array<bigint>")
    listed = F.arrow_udf(item_windows, f"array<{WINDOW}>")
    grams = written(items.select(F.explode(hashes("text")).alias("h")).distinct(), "benchmark-fingerprints")
    windows = items.select("id", F.explode(listed("text")).alias("w")).groupBy("w.n", "w.key1", "w.key2").agg(
        F.sort_array(F.collect_set("id")).alias("items"))
    return grams, written(windows, "benchmark-windows"), lengths


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct(n_words, n_hit, items, contaminated).

    ``n_hit`` counts the words inside an occurrence of an item's window,
    ``items`` are the ids (text, sorted, once each; a null id is the empty
    text) of items with an occurring window. Null and word-free texts have no
    words; null and word-free items no windows; an empty benchmark hits nothing. Texts are read whole,
    repeated rows and ids each get their result, other columns stay.
    """
    grams, windows, lengths = _benchmark_tables(benchmark, item_id_col, item_text_col)
    key = ["t1", "t2"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(*_text_hash(text, key), text.alias("text"))
    hashes = F.arrow_udf(lambda texts: fingerprints(texts, lengths, False), "array<bigint>")
    marks = narrow.select(*key, F.explode(hashes("text")).alias("h"))
    hits = split_join(marks, grams, ["h"], "left_semi").groupBy(*key).agg(F.collect_set("h").alias("hits"))
    hits = written(hits, "fingerprint-hits")
    near = F.arrow_udf(lambda texts, found: near_windows(texts, found, lengths), f"array<{WINDOW}>")
    around = split_join(narrow, hits, key).select(*key, F.explode(near("text", "hits")).alias("w")).select(*key, "w.*").distinct()
    matched = split_join(around, windows, ["n", "key1", "key2"])
    results = matched.groupBy(*key).agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    results = written(results.select(*key, covered(F.col("spans")).alias("n_hit"), "items"), "contaminated-texts")

    own = {c: temporary_name(docs, c) for c in (*key, "n_hit", "items", "n_words")}
    result = temporary_name(docs, "scan")
    tagged = docs.select("*", *_text_hash(text, [own[k] for k in key]))
    scanned = split_join(tagged, results.select(*[F.col(c).alias(own[c]) for c in (*key, "n_hit", "items")]), [own[k] for k in key], "left")
    scanned = scanned.withColumn(own["n_words"], F.arrow_udf(word_counts, "bigint")(F.col(text_col)))
    n_hit, n_words = F.coalesce(F.col(own["n_hit"]), F.lit(0)), F.col(own["n_words"])
    out = scanned.withColumn(result, F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"), F.coalesce(F.col(own["items"]), F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated")))
    return out.select(*docs.columns, result), result


def _text_hash(text: Column, names: list[str]) -> list[Column]:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64(F.lit(i), text).alias(n) for i, n in enumerate(names)]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` of whose words less than one in twenty are hit."""
    scanned, result = scan(docs, benchmark, **names)
    return scanned.where(~F.col(f"{result}.contaminated")).select(docs.columns)
