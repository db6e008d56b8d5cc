"""Sampling, shuffling and fold assignment.

A sample of ``n`` rows takes the ``n`` smallest of a pseudo-random key. The n-th smallest key is
found from counts: the rows are counted by the first digits of their key, and only the group in which the n-th
lies (one row in 65,536) is put in order. The
sample is a filter by that key; nothing is sorted as a whole or merged on the driver.
Equal rows are counted first and told apart by their number (see ``copies``), so rows that
repeat are drawn as often as their share of the table and never fill one task.

Exact per-key ranks (``rank_within``) split rows by a prefix of their sort key into
buckets, rank them inside each (key, bucket) group in parallel, and shift by the row count
of earlier buckets. The offsets come from a count table of at most ``keys x buckets`` rows. A
label holding a third of the table is therefore ranked by many tasks, and the result
is the same as one ``row_number`` over the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col
from threadsift.operators.copies import free_names, numbered_copies, quoted, repeated, run_lengths

# Hex digits of the md5 sort key used as bucket: 16**4 = 65,536 buckets, so a
# label holding half of a 100 TB table still splits into groups under 1 GB.
BUCKET_HEX_DIGITS = 4
#: Largest sample whose keys (24 bytes a row) are broadcast to the rows; larger ones meet them in a shuffle.
BROADCAST_ROWS = 1_000_000
#: Key of rows without an id: after every md5.
NO_ID = "~"


def hash_key(id_col, salt: str = "") -> Column:
    """Deterministic pseudo-random sort key of a row id (md5 hex text)."""
    base = as_col(id_col).cast("string")
    return F.md5(F.concat(F.lit(salt), base) if salt else base)


def random_sample(df: DataFrame, n, seed: int = 42) -> DataFrame:
    """O3: ``n`` seeded rows (a number, or a column such as a scalar subquery), each row equally likely.

    The same rows are chosen however the table is partitioned. Copies of a row are drawn
    independently of each other, so a row that makes up a third of the table makes up about a third of the sample.
    Two passes: one over hashes of the rows (16 bytes a distinct row cross a shuffle), one to fetch the chosen rows.
    """
    h1, h2, copies, nth, key, taken = free_names(df, "hash1", "hash2", "copies", "nth", "key", "taken")
    columns = [quoted(c) for c in df.columns]
    hashed = df.select("*", F.xxhash64(F.lit(seed), *columns).alias(h1), F.xxhash64(F.lit(~seed), *columns).alias(h2))
    runs = hashed.groupBy(h1, h2).agg(F.count(F.lit(1)).alias(copies))
    place = F.xxhash64(F.lit(seed), F.col(h1), F.col(h2), F.col(nth))
    each = repeated(runs, copies, nth).withColumn(key, F.struct(place.alias("place"), h1, h2, nth))
    last = nth_smallest(each, F.col(key), F.shiftright(F.col(key)["place"], 48), n)
    chosen = each.where(F.col(key) <= last.select("key").scalar()).groupBy(h1, h2).agg(F.count(F.lit(1)).alias(taken))
    if isinstance(n, int) and n <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)  # at most n rows
    found = hashed.join(chosen, [h1, h2]).select(*columns, taken).distinct()
    return repeated(found, taken, nth).drop(nth)


def hash_sample(df: DataFrame, n, id_col: str, salt: str = "") -> DataFrame:
    """O3, reproducible across engines: the ``n`` rows with the smallest (md5(id), id).

    ``n`` is a number or a column (such as a scalar subquery). Rows without an id come last. Of
    the rows that share the last id the first by row hash are taken. The first pass reads the ids only.
    """
    copies, = free_names(df, "copies")
    ids = df.groupBy(quoted(id_col)).agg(F.count(F.lit(1)).alias(copies))
    return _hash_sample(df, ids, copies, n, id_col, salt)


def _hash_sample(df: DataFrame, ids: DataFrame, copies: str, n, id_col: str, salt: str) -> DataFrame:
    """``ids`` has each id once with its number of rows."""
    md5 = F.coalesce(hash_key(quoted(id_col), salt), F.lit(NO_ID))
    key = F.struct(md5.alias("md5"), quoted(id_col).alias("id"))
    last = nth_smallest(ids, key, F.substring(md5, 1, BUCKET_HEX_DIGITS), n, F.col(copies))
    whole = df.where(key < last.select("key").scalar())
    # the rows of the last id: as many of them as there is room for, by row hash
    row, number = free_names(df, "row_hash", "copies")
    edge = run_lengths(df.where(key == last.select("key").scalar()), number)
    hashed = F.xxhash64(*map(quoted, df.columns))
    order = F.struct(hashed.alias(row), *map(quoted, df.columns))
    end = nth_smallest(edge, order, F.shiftright(hashed, 48), last.select("room").scalar(), F.col(number))
    part = edge.where(order < end.select("key").scalar()).unionByName(end.select("key.*", F.col("room").alias(number)).drop(row))
    return whole.unionByName(repeated(part, number, row).drop(row))


def nth_smallest(rows: DataFrame, key: Column, prefix: Column, n, copies: Column | None = None) -> DataFrame:
    """One row: the ``key`` of the ``n``-th row in the order of ``key`` (the last one, if there are fewer) and ``room``.

    A row counts as ``copies`` rows (one, if not given); ``room`` is how many copies of that key are among the first ``n``.
    ``prefix`` is monotone in ``key`` and has at most 65,536 values; without rows, or with ``n`` 0, the result is null.
    """
    wanted = n if isinstance(n, Column) else F.lit(n)
    listed = rows.select(prefix.alias("prefix"), key.alias("key"), (F.lit(1) if copies is None else copies).alias("size"))
    before = F.col("upto") - F.col("size")
    sizes = listed.groupBy("prefix").agg(F.sum("size").alias("size"))
    # at most 65,536 rows
    upto = sizes.withColumn("upto", F.sum("size").over(Window.orderBy("prefix")))
    # the last group that is touched, and the rows wanted of it: one row
    touched = upto.select("prefix", (wanted - before).alias("room")).where(F.col("room") > 0)
    end = touched.agg(F.max_by(F.struct("prefix", "room"), "prefix").alias("end")).select("end.*")
    inside = listed.join(F.broadcast(end), "prefix").withColumn("upto", F.sum("size").over(Window.orderBy("key")))
    last = F.max_by(F.struct("key", F.least(F.col("room") - before, F.col("size")).alias("room")), "key")
    return inside.where(before < F.col("room")).agg(last.alias("last")).select("last.*")


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample of about ``fraction`` of the rows (no shuffle)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def full_shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """Every row once, in an order given by a hash of seed and row (whatever the layout was).

    Copies of a row go to places of their own, not next to each other.
    """
    nth, = free_names(df, "nth")
    place = F.xxhash64(F.lit(seed), *map(quoted, df.columns), F.col(nth))
    return numbered_copies(df, nth).orderBy(place, nth).drop(nth)


def size_target_sample(df: DataFrame, size_col: Column, target, id_col: str,
                       salt: str = "") -> DataFrame:
    """Shrink to about ``target`` size units (e.g. bytes; a number or a column over the total ``total``).

    ``ratio = target / total``; everything is kept when the data is already
    smaller. Otherwise the ``floor(count * ratio)`` rows first in md5(id)
    order are kept: a reproducible head of a pseudo-random order. Ids and sizes give count, total
    and the last key; whole rows are only read where they are filtered.
    """
    target = target if isinstance(target, Column) else F.lit(target)
    copies, size = free_names(df, "copies", "size")
    ids = df.groupBy(quoted(id_col)).agg(F.count(F.lit(1)).alias(copies), F.sum(size_col).alias(size))
    stats = ids.agg(F.sum(copies).alias("n"), F.sum(size).alias("total"))
    keep = F.when(F.coalesce("total", F.lit(0)) <= target, F.col("n")).otherwise(
        F.floor(F.col("n") * (target / F.col("total"))))
    return _hash_sample(df, ids, copies, stats.select(keep.cast("bigint")).scalar(), id_col, salt)


def rank_within(df: DataFrame, keys: Sequence[str], sort_key: Column, bucket: Column,
                rank_col: str = "rank") -> DataFrame:
    """Exact 0-based rank of each row inside ``keys`` ordered by ``sort_key``.

    ``bucket`` must be monotone in ``sort_key`` (for example a prefix of it),
    so that ordering by (bucket, sort_key) equals ordering by sort_key.
    """
    keys = list(keys)
    base = df.withColumn("_sk", sort_key).withColumn("_b", bucket)
    local = Window.partitionBy(*keys, "_b").orderBy("_sk")
    tagged = base.withColumn("_local", F.row_number().over(local) - 1)
    # bucket sizes straight from the input: a hash aggregate, no sort
    counts = base.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    running = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_b", F.coalesce(F.sum("_cnt").over(running), F.lit(0)).alias("_off"))
    # the offset table has one row per (key, bucket); adaptive execution broadcasts it if it is small
    ranked = tagged.join(offsets, keys + ["_b"])
    return ranked.withColumn(rank_col, F.col("_off") + F.col("_local")).drop("_sk", "_b", "_local", "_off")


def stratified_folds(df: DataFrame, label_col: str, id_col: str, k: int = 5,
                     salt: str = "") -> DataFrame:
    """Fold ``0..k-1`` per row; within each label, fold sizes differ by at most one.

    Rows of each label are ordered by md5(id) and dealt round-robin.
    """
    key = hash_key(id_col, salt)
    ranked = rank_within(df, [label_col], key, F.substring(key, 1, BUCKET_HEX_DIGITS), "_pos")
    return ranked.withColumn("fold", (F.col("_pos") % k).cast("int")).drop("_pos")
