"""Exact substring dedup by column-wise construction of a collection's suffix order.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else. The suffix order (Burrows-Wheeler transform) and the common prefixes
of a collection are built column-wise: each round inserts one symbol of every
document, moving the transform and the prefixes on by one sequential pass.
A round rewrites what was built so far and there are as many rounds as the
longest document has symbols, so the construction is not run on the corpus
as it stands but on small collections that hold every possible match:

1. Of the ``ANCHOR``-byte substrings in each window of ``length`` bytes the one
   with the smallest hash is its anchor (winnowing). Equal windows have equal
   anchors at equal places, so windows with an anchor that occurs once are
   unique. The windows of one anchor are consecutive: their bytes are the
   anchor's context.
2. If all contexts of an anchor are equal, all its windows are repeated.
3. Else the contexts form a collection (``ANCHOR`` shared bytes count as one
   symbol, so at most ``2 * (length - ANCHOR) + 1`` rounds are needed), and a
   window is repeated if the common prefix with a neighbour in the suffix
   order covers it.
4. An anchor with more than ``GROUP_LIMIT`` occurrences (the edge of a passage
   that very many documents share) would make an unbounded collection. Its
   equal contexts are counted with a partial aggregate, and the windows of its
   distinct contexts by their 128-bit digests, which is exact as well.

Texts are named by a 64-bit hash and their size; copies of a text share one
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm import arrays
from threadsift.llm.tables import checkpoint

LENGTH = 200
ANCHOR = 136
#: Occurrences of an anchor whose contexts one task may hold (some 20 MB at most).
GROUP_LIMIT = 20_000
#: Contexts that are ordered together.
COLLECTION = 2_000

_OWN, _AT = 8, 8  # bits of a place for the number of windows and the anchor's offset


def anchors(texts: pa.Array, length: int = LENGTH, anchor: int = ANCHOR) -> pa.Array:
    """Per text: (h, c, place) of each anchor: its hash, its context's hash, where its windows start.

    ``place`` is ``start << 16 | windows << 8 | offset of the anchor``.
    """
    data, offsets = arrays.text_buffer(texts)
    parts, counts = [], [np.zeros(1, np.int64)]
    for first, last in arrays.blocks(offsets):
        here = offsets[first:last + 1] - offsets[first]
        h, c, start, own, at = _anchors(data[offsets[first]:offsets[last]], here, length, anchor)
        row = np.searchsorted(here, start, side="right") - 1
        place = ((start - here[row]) << (_OWN + _AT)) | (own << _AT) | at
        parts.append((h.view(np.int64), c.view(np.int64), place))
        counts.append(np.bincount(row, minlength=last - first))
    ends = np.cumsum(np.concatenate(counts))
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    struct = pa.StructArray.from_arrays([pa.array(x) for x in columns], ["h", "c", "place"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Winnowing over a block of texts, in overlapping pieces of bounded size."""
    found = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], *([np.zeros(0, np.int64)] for _ in range(3))]
    step = arrays.BLOCK_BYTES
    row_ends = offsets[1:]
    carry = None  # the anchor at the end of a piece may have more windows in the next
    for base in range(0, max(len(data) - length + 1, 0), step):
        piece = data[base:base + step + length - 1]
        windows = len(piece) - length + 1
        at = np.arange(base, base + windows)
        row = np.searchsorted(row_ends, at, side="right")
        valid = at + length <= row_ends[row]
        up, down = arrays._power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:len(piece)], out=sums[1:])
        h = arrays.mix((sums[anchor:] - sums[:-anchor]) * down[:len(piece) - anchor + 1])
        place = window_argmin(h, length - anchor + 1)
        new = np.ones(windows, bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new & valid)
        # windows of an anchor: up to the next new one or the end of the row
        stop = np.flatnonzero(np.append((new | ~valid)[1:], True))
        last = stop[np.searchsorted(stop, first)]
        start, end = base + first, base + last
        where = base + place[first]
        key = h[place[first]]
        if carry is not None and len(start) and carry[0] == where[0] and carry[2] + 1 == start[0]:
            start[0] = carry[1]
            for x in found:
                x[-1] = x[-1][:-1]
        if len(start):
            carry = (where[-1], start[-1], end[-1])
        inside = start >= base
        c = np.empty(len(start), np.uint64)
        lo, hi = start[inside] - base, end[inside] - base + length
        c[inside] = (sums[hi] - sums[lo]) * down[lo]
        for i in np.flatnonzero(~inside):  # a context that began in the piece before
            c[i] = arrays.span_hash_raw(data[start[i]:end[i] + length])
        size = (end - start).astype(np.uint64) * np.uint64(256) + (where - start).astype(np.uint64)
        c = arrays.mix(c ^ arrays.mix(size + np.uint64(1)))
        for x, values in zip(found, (key, c, start, end - start + 1, where - start)):
            x.append(values)
    return tuple(np.concatenate(x) for x in found)


def window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (the first of equal ones) in each window of ``width``."""
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    pad = (-len(keys)) % width
    table = np.append(keys, np.full(pad, ~np.uint64(0))).reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return (np.minimum(backward[:n], forward[width - 1:width - 1 + n]) & low).astype(np.int64)


def column_wise_order(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, suffix length, common prefix with the one before) in suffix order.

    ``symbols[i]`` is document i from its end backwards (int16, from 0 on),
    ``lengths`` the documents' sizes; every document ends in a mark of its own.
    Round j inserts the suffixes of length j: a suffix's place follows from the
    place of the one shorter by a symbol and the number of equal symbols before
    it in the transform, and its common prefixes from the smallest one between
    equal symbols.
    """
    m = len(lengths)
    size = int(lengths.max(initial=0)) + 1
    transform = np.where(lengths > 0, symbols[:, 0] if symbols.shape[1] else -1, -1).astype(np.int16)
    prefix = np.zeros(m, np.int16)
    names = np.arange(m, dtype=np.int64) * size  # document * size + suffix length
    at = np.arange(m)  # place of each document's latest suffix
    for j in range(1, size):
        live = np.flatnonzero(lengths >= j)
        order = np.argsort(transform, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ended = int((transform < 0).sum())
        old = at[live]
        ranks = rank[old]
        new = m + ranks - ended
        # common prefixes with the neighbours that begin with the same symbol
        above, below = np.maximum(ranks - 1, 0), np.minimum(ranks + 1, len(order) - 1)
        has_above = (ranks > 0) & (transform[order[above]] == transform[old])
        has_below = (ranks + 1 < len(order)) & (transform[order[below]] == transform[old])
        up = np.zeros(len(live), np.int16)
        up[has_above] = 1 + _range_min(prefix, order[above[has_above]] + 1, old[has_above] + 1)
        down = np.zeros(len(live), np.int16)
        down[has_below] = 1 + _range_min(prefix, old[has_below] + 1, order[below[has_below]] + 1)
        total = len(transform) + len(live)
        kept = np.ones(total, bool)
        kept[new] = False
        grown = np.empty(total, np.int16)
        grown[kept] = transform
        grown[new] = np.where(lengths[live] > j, symbols[live, min(j, symbols.shape[1] - 1)], -1)
        longer = np.empty(total, np.int16)
        longer[kept] = prefix
        longer[new] = up
        # the suffix after a new one: its common prefix is with the new one now
        follows = new + 1
        inside = follows < total
        old_next = inside.copy()
        old_next[inside] = kept[follows[inside]]
        longer[follows[old_next]] = down[old_next]
        named = np.empty(total, np.int64)
        named[kept] = names
        named[new] = live * size + j
        transform, prefix, names = grown, longer, named
        at[live] = new
    return names // size, names % size, prefix


def _range_min(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Smallest value in each (non-empty) range."""
    size = stop - start
    first = np.cumsum(size) - size
    if not len(size):
        return np.zeros(0, values.dtype)
    index = np.arange(size.sum()) - np.repeat(first - start, size)
    return np.minimum.reduceat(values[index], first)


def repeated_windows(groups: np.ndarray, contexts: list[bytes], places: np.ndarray, length: int = LENGTH,
                     anchor: int = ANCHOR) -> list[np.ndarray]:
    """Flags of the windows of each context that also occur in another context.

    ``groups`` number equal anchors (contexts of a group differ), ``places`` are the anchors' places.
    """
    own, at = (places >> _AT) & 0xFF, places & 0xFF
    sizes = np.array([len(c) for c in contexts])
    lengths = sizes - anchor + 1
    symbols = np.zeros((len(contexts), int(lengths.max(initial=1))), np.int16)
    for i, context in enumerate(contexts):
        data = np.frombuffer(context, np.uint8).astype(np.int16)
        data = np.concatenate([data[:at[i]], [256 + groups[i]], data[at[i] + anchor:]])
        symbols[i, :len(data)] = data[::-1]
    document, suffix, prefix = column_wise_order(symbols, lengths)
    covered = np.maximum(prefix, np.append(prefix[1:], 0)) > length - anchor
    start = lengths[document] - suffix
    hit = covered & (start < own[document])
    out = [np.zeros(n, bool) for n in own]
    for d, s in zip(document[hit].tolist(), start[hit].tolist()):
        out[d][s] = True
    return out


_SPAN = pa.schema([("t", pa.int64()), ("bytes", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def _order_groups(batches):
    """Rows (h, t, bytes, place, context) sorted by h -> repeated spans of their texts."""

    def flush(rows):
        # equal contexts are repeated as they are; the others are ordered together
        seen: dict[tuple, list[int]] = {}
        for i, (_, _, _, place, context) in enumerate(rows):
            at = place & 0xFF
            # contexts of one anchor (its bytes decide, not their hash) and shape
            seen.setdefault((context[at:at + ANCHOR], place & 0xFFFF, context), []).append(i)
        ids: dict[bytes, int] = {}
        keys = list(seen)
        groups = np.array([ids.setdefault(k[0], len(ids)) for k in keys], np.int64)
        flags = repeated_windows(groups, [k[2] for k in keys], np.array([k[1] for k in keys], np.int64))
        out = []
        for key, flag in zip(keys, flags):
            if len(seen[key]) > 1:
                flag[:] = True
            starts, ends = arrays.runs(flag, np.zeros(1, np.int64))
            for i in seen[key]:
                _, t, size, place, _ = rows[i]
                at = place >> (_OWN + _AT)
                out += [(t, size, at + s, at + e - 1 + LENGTH) for s, e in zip(starts.tolist(), ends.tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _SPAN)], schema=_SPAN)

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if len(rows) >= COLLECTION and row[0] != rows[-1][0]:
                yield from flush(rows)
                rows = []
            rows.append(row)
    if rows:
        yield from flush(rows)


def _packed(texts: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack(t.encode()) for t in texts.to_pylist()], pa.binary())


def _unpacked(packed: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(t).decode() for t in packed.to_pylist()], pa.large_string())


def _slices(texts: pa.Array, places: pa.Array) -> pa.Array:
    """Context bytes of each place of each text."""
    data, offsets = arrays.text_buffer(texts)
    out = []
    for i, list_of in enumerate(places.to_pylist()):
        base = offsets[i]
        out.append([data[base + (p >> 16):base + (p >> 16) + ((p >> 8) & 0xFF) - 1 + LENGTH].tobytes() for p in list_of])
    return pa.array(out, pa.list_(pa.binary()))


def _digests(contexts: pa.Array, places: pa.Array) -> pa.Array:
    """(start, 128-bit digest) of each window of a context."""
    out = []
    for context, p in zip(contexts.to_pylist(), places.to_pylist()):
        out.append([{"start": (p >> 16) + i, "digest": xxhash.xxh3_128_digest(context[i:i + LENGTH])} for i in range((p >> 8) & 0xFF)])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("digest", pa.binary())])))


def _remove(texts: pa.Array, places: pa.Array, spans: pa.Array) -> pa.Array:
    """Per text: bytes, removed bytes, removed runs, the bytes that stay."""
    data, offsets = arrays.text_buffer(texts)
    out = []
    for i, (whole, some) in enumerate(zip(places.to_pylist(), spans.to_pylist())):
        text = data[offsets[i]:offsets[i + 1]]
        cover = np.zeros(len(text) + 1, np.int32)
        whole = np.array(whole or [], np.int64)
        starts = np.concatenate([whole >> 16, np.array([s["start"] for s in some or []], np.int64)])
        ends = np.concatenate([(whole >> 16) + ((whole >> 8) & 0xFF) - 1 + LENGTH, np.array([s["end"] for s in some or []], np.int64)])
        np.add.at(cover, starts, 1)
        np.add.at(cover, ends, -1)
        gone = np.cumsum(cover[:-1]) > 0
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
        out.append({"n_bytes": len(text), "n_removed": int(gone.sum()), "n_spans": runs, "kept": text[~gone].tobytes()})
    return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))


def dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans and the bytes that stay (``kept``).

    A null text is empty. Every copy of a repeated string goes, the first
    included; texts shorter than ``LENGTH`` bytes stay as they are. What is
    left may end inside a character of several bytes, hence bytes. Long texts are handled whole (a
    task holds one at a time); repeated rows each get their result, as copies of each other; columns beside id and
    text are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("t"),
                       F.octet_length(text).alias("bytes"))
    # texts travel compressed
    pack = F.arrow_udf(lambda texts: _packed(texts), "binary")
    packed = rows.select("id", pack("text").alias("text"), "t", "bytes")

    find = F.arrow_udf(lambda texts: anchors(texts), "array<struct<h: bigint, c: bigint, place: bigint>>")
    found = rows.select("t", "bytes", F.explode(find("text")).alias("a"))
    per_anchor = found.select("a.h", "a.c").groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    per_anchor = per_anchor.where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed"), (F.col("n") > GROUP_LIMIT).alias("many"))
    # distinct anchors are the build side; a hot anchor's occurrences are split by adaptive execution
    placed = found.select("t", "bytes", "a.h", "a.place").join(per_anchor.hint("shuffle_hash"), "h")
    case = F.when(~F.col("mixed"), 0).when(F.col("many"), 2).otherwise(1)
    of_case = lambda c, value: F.collect_set(F.when(case == c, value))
    texts = checkpoint(placed.groupBy("t", "bytes").agg(
        of_case(0, F.col("place")).alias("whole"), of_case(1, F.struct("h", "place")).alias("few"), of_case(2, F.col("place")).alias("many")))

    # texts are shuffled to their places once, for the contexts and for the result: all three joins read
    # the same columns (that is what the ids are passed for)
    cut = F.arrow_udf(lambda texts, places, _: _slices(_unpacked(texts), places), "array<binary>")

    def contexts(column: str, place: Column) -> DataFrame:
        found = packed.join(texts.where(F.size(column) > 0).select("t", "bytes", column), ["t", "bytes"])
        found = found.withColumn("contexts", cut("text", place, "id"))
        return found.select("t", "bytes", F.explode(F.arrays_zip(column, "contexts")).alias("x"))

    few = contexts("few", F.transform("few", lambda x: x["place"]))
    few = few.select("x.few.h", "t", "bytes", "x.few.place", F.col("x.contexts").alias("context"))
    ordered = few.repartition("h").sortWithinPartitions("h").mapInArrow(_order_groups, "t bigint, bytes int, start bigint, end bigint")

    many = contexts("many", F.col("many")).select("t", "bytes", F.col("x.many").alias("place"), F.col("x.contexts").alias("context"))
    distinct = many.groupBy("context").agg(F.count("*").alias("n"), F.min(F.struct("t", "bytes", "place")).alias("one"))
    start = F.shiftright("place", 16)
    windows = F.shiftright("place", 8).bitwiseAND(F.lit(0xFF))
    equal = many.join(distinct.where("n > 1").select("context"), "context").select(
        "t", "bytes", start.alias("start"), (start + windows - 1 + LENGTH).alias("end"))
    digest = F.arrow_udf(lambda contexts, places: _digests(contexts, places), "array<struct<start: bigint, digest: binary>>")
    parts = distinct.select("n", "one.t", "one.bytes", F.explode(digest("context", "one.place")).alias("w"))
    parts = parts.select("n", "t", "bytes", "w.start", "w.digest")
    again = parts.groupBy("digest").agg(F.count("*").alias("k")).where("k > 1").select("digest")
    counted = parts.where("n = 1").join(again, "digest").select("t", "bytes", "start", (F.col("start") + LENGTH).alias("end"))

    spans = ordered.unionByName(equal).unionByName(counted).groupBy("t", "bytes").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    remove = F.arrow_udf(lambda a, b, c: _remove(_unpacked(a), b, c), "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept: binary>")
    out = packed.join(texts.select("t", "bytes", "whole"), ["t", "bytes"], "left").join(spans, ["t", "bytes"], "left")
    out = out.select(F.col("id").alias(id_col), remove("text", "whole", "spans").alias("r"))
    return out.select(id_col, "r.*")

