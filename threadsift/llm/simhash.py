"""SimHash near-dedup by multi-index hashing.

Method. A fingerprint is cut into two segments of 32 bits, and a table holds every
fingerprint under the value of each of its segments. Two fingerprints within r bits differ by at most
r // 2 bits in one segment or the other. So for each segment the small Hamming ball of that radius is
enumerated around a fingerprint's value, every value of the ball is looked up in the segment's
table, and the complete distance to each fingerprint found there is verified.

Segment values that more than ``BUCKET`` fingerprints share (a large family of near copies) are not
looked up that way, as that would emit the pairs of a group. Fingerprints whose ball holds such a value are
split by complete keys instead: each is entered under the points within a few bits of itself (the
whole fingerprint, not one segment), two within r bits share such a point, and the members of
a point link to its smallest one. At most 65 fingerprints lie within one bit of a point, so no key is hot.

Copies are one row before the search (a partial aggregate per fingerprint). Groups come from
alternating large-star and small-star steps over the links. Joins in which one fingerprint or
hub can have very many rows have exchanges that adaptive execution splits (``tables.split_join``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm import arrays
from threadsift.llm.tables import checkpoint, split_join, temporary_name

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEGMENT_BITS = 32
SEGMENTS = 64 // SEGMENT_BITS
#: Most fingerprints of a segment value that are fetched by a look-up.
BUCKET = 64


def fingerprints(texts: pa.Array, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """SimHash of each text (uint64), from the XXH64 of its word shingles."""
    data, offsets = arrays.text_buffer(texts)
    out = np.zeros(len(offsets) - 1, np.uint64)
    digest = xxhash.xxh64_intdigest
    for first, last in arrays.blocks(offsets):
        hashes: list[int] = []
        begins, rows = [], []
        for row in range(first, last):
            words = data[offsets[row]:offsets[row + 1]].tobytes().lower().split()
            if not words:
                continue
            begins.append(len(hashes))
            rows.append(row)
            if len(words) < shingle_words:
                hashes.append(digest(b" ".join(words), SEED))
            else:
                grams = zip(*(words[j:] for j in range(shingle_words)))
                hashes.extend([digest(g, SEED) for g in map(b" ".join, grams)])
        if not rows:
            continue
        out[rows] = majority(np.array(hashes, np.uint64), np.array(begins))
    return out


def majority(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Per group of consecutive hashes: the bits set in over half of them."""
    ends = np.append(begins[1:], len(hashes))
    counts = np.zeros((len(begins), 64), np.int64)
    step = 1 << 17  # bounds the unpacked bits, also inside a long text
    for at in range(0, len(hashes), step):
        stop = min(at + step, len(hashes))
        bits = np.unpackbits(hashes[at:stop].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = int(np.searchsorted(ends, at, side="right"))
        last = int(np.searchsorted(begins, stop, side="left"))
        inside = np.maximum(begins[first:last] - at, 0)
        counts[first:last] += np.add.reduceat(bits, inside, axis=0, dtype=np.int64)
    set_bits = counts * 2 > (ends - begins)[:, None]
    return np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint_column(text, shingle_words: int = SHINGLE_WORDS):
    """Column of SimHash fingerprints as bigint (the unsigned bits, reinterpreted)."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(texts, shingle_words).view(np.int64))

    return simhash(text)


def fingerprint_text(fingerprint):
    """16 lowercase hex digits of a bigint fingerprint."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _ball(bits: int, radius: int) -> Column:
    """The masks of at most ``radius`` of ``bits`` bits."""
    masks = [sum(1 << b for b in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)]
    return F.array(*[F.lit(_signed(m)) for m in masks])


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b), a > b: links between the distinct fingerprints of column ``fingerprint``.

    The links connect exactly what pairs within ``max_distance`` (1 to 3) connect. Outside crowded segment
    values they are those pairs.
    """
    if not 1 <= max_distance <= 3:
        raise ValueError("distances of 1 to 3 bits are served")
    fp = F.col("fingerprint")
    values = F.array(*[F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned(fp, SEGMENT_BITS * s)
                                .bitwiseAND((1 << SEGMENT_BITS) - 1).alias("value")) for s in range(SEGMENTS)])
    entries = distinct.select(fp, F.explode(values).alias("at")).select("at.segment", "at.value", "fingerprint")
    counts = entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    crowded = checkpoint(counts.where(F.col("n") > BUCKET).select("segment", "value", F.lit(True).alias("crowded")))
    at = ["segment", "value"]
    table = split_join(entries, crowded, at, "left_anti").groupBy(*at).agg(F.collect_list("fingerprint").alias("members"))
    balls = F.transform(_ball(SEGMENT_BITS, max_distance // SEGMENTS), lambda mask: F.col("value").bitwiseXOR(mask))
    probes = split_join(entries.select("segment", F.explode(balls).alias("value"), "fingerprint"), crowded, at, "left")
    fetched = probes.where("crowded is null").join(table, at).select(fp, F.explode("members").alias("other"))
    near = fetched.where((fp > F.col("other")) & (F.bit_count(fp.bitwiseXOR(F.col("other"))) <= max_distance))
    split = _point_links(probes.where("crowded").select(fp).distinct(), max_distance)
    return near.select(fp.alias("a"), F.col("other").alias("b")).union(split).distinct()


def _point_links(members: DataFrame, max_distance: int) -> DataFrame:
    """(a, b) that connect the fingerprints within ``max_distance`` of each other, by the points between them.

    Of two such fingerprints one lies within r // 2 bits of a point and the other within the rest; all around the point
    link to its smallest near one, which is within r bits of each.
    """
    fp = F.col("fingerprint")
    inner, outer = max_distance // 2, max_distance - max_distance // 2

    def around(radius):
        return members.select(fp, F.explode(F.transform(_ball(64, radius), lambda mask: fp.bitwiseXOR(mask))).alias("point"))

    if inner == outer:
        found = around(outer).withColumn("smallest", F.min(fp).over(Window.partitionBy("point")))
    else:
        found = around(outer).join(around(inner).groupBy("point").agg(F.min(fp).alias("smallest")), "point")
    distance = F.bit_count(fp.bitwiseXOR(F.col("smallest")))
    near = found.where((fp != F.col("smallest")) & (distance <= max_distance))
    return near.select(F.greatest(fp, "smallest").alias("a"), F.least(fp, "smallest").alias("b"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps; each halves the distance to
    the root, so a few rounds are enough. A hub's links are aggregated map-side,
    and the joins with its smallest neighbour can be split.
    """
    before = None
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = split_join(both.where("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, low, ["a"]).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                            F.col("m").alias("b"))
        edges = checkpoint(small.distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _grouped(docs: DataFrame, text_col: str, id_col: str, shingle_words: int, max_distance: int) -> DataFrame:
    """(id, text_key, fingerprint, root, component_id) of every row; ``root`` names its group."""
    fp = checkpoint(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"),
                                fingerprint_column(F.col(text_col), shingle_words).alias("fingerprint")))
    distinct = fp.groupBy("fingerprint").agg(F.min("id").alias("smallest_id"))
    roots = components(links(distinct, max_distance)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    component = rooted.groupBy("root").agg(F.min("smallest_id").alias("component_id"))
    return split_join(fp, rooted.select("fingerprint", "root").join(component, "root"), ["fingerprint"])


def text_key(text):
    """Tells the texts of repeated ids apart (a null text is the empty one)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row (id, fingerprint, component_id) per document.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_distance`` bits. A null or blank text has fingerprint zero and links
    like any other; repeated rows are rows of one group; a null id takes part
    but is never the smallest (null only if all ids of the group are).
    """
    out = _grouped(docs, text_col, id_col, shingle_words, max_distance)
    return out.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group: the smallest id (a null id only if all are).

    Of repeated rows with that id one stays (of the smallest text key, then any).
    """
    groups = _grouped(docs, text_col, id_col, shingle_words, max_distance)
    first = F.min_by(F.struct("id", "text_key", "copies"), F.struct(F.col("id").isNull(), "id", "text_key"))
    keep = groups.groupBy("root", "id", "text_key").agg(F.count("*").alias("copies")).groupBy("root").agg(first.alias("k"))
    own, key, copies = (temporary_name(docs, n) for n in ("kept_id", "kept_text_key", "copies"))
    keep = keep.select(F.col("k.id").alias(own), F.col("k.text_key").alias(key), F.col("k.copies").alias(copies))
    kept = docs.join(keep, docs[id_col].eqNullSafe(F.col(own)) & (text_key(docs[text_col]) == F.col(key)))
    once = kept.where(F.col(copies) == 1).select(docs.columns)
    # only rows that are there several times are brought together
    several = kept.where(F.col(copies) > 1).groupBy(own, key).agg(F.first(F.struct(*docs.columns)).alias(copies))
    return once.unionByName(several.select(f"{copies}.*"))
