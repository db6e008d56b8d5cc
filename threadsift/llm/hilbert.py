"""Sharding by Hilbert order: runs of a space-filling curve through the metadata columns.

Every dimension is quantised to ``2 ** bits`` steps by rank: a value's coordinate is the
share of all rows with a smaller value. A value that a third of the rows hold so takes a
third of its axis, and any type that Spark can order will do. The coordinates give the
place on a Hilbert curve; rows are sorted by it (ties: by all columns) and the order is
cut into runs whose numbers of rows differ by at most one. Neighbours on the curve are
neighbours in every dimension, so the smallest and largest value of each column let a
reader skip most shards, whichever columns it filters by (``shard_ranges``).

Built from DataFrame functions only: the curve is a table of states that every
level of the coordinates' bits looks up once.

Results in special cases: a null sorts first, as a value of its own; rows that are equal in every
column are numbered like any other, one after the other; texts may have any length, but
sort narrow columns (as the query does) and join wide ones later; an empty table has
no rows in any shard; other columns stay, the result column takes a name that is free.
With fewer rows than shards, some shards are empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.tables import checkpoint, temporary_name
from threadsift.operators.copies import numbered_copies, quoted

#: Steps of a dimension: 2 ** 8.
BITS = 8
_ROW_MASK = (1 << 33) - 1  # monotonically_increasing_id counts the rows of a partition in its low 33 bits


def _rotated(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def curve_table(n: int) -> list[int]:
    """The curve in ``n`` dimensions: entry ``state * 2**n + corner`` is ``next state * 2**n + place of the corner``.

    A state is the corner where the curve enters a cube and the direction in which it leaves
    it (entry * n + direction). A cube's corners are visited in the order of the reflected Gray code, turned and
    mirrored by the state.
    """
    gray = [i ^ (i >> 1) for i in range(1 << n)]
    inverse = {g: i for i, g in enumerate(gray)}

    def entry(place: int) -> int:
        return gray[2 * ((place - 1) // 2)] if place else 0

    def direction(place: int) -> int:
        ones = place if place % 2 else place - 1 if place else 0
        return ((ones + 1) & ~ones).bit_length() - 1 if place else 0  # trailing ones

    table = []
    for state in range(n << n):
        start, turn = divmod(state, n)
        for corner in range(1 << n):
            place = inverse[_rotated(corner ^ start, n - (turn + 1) % n, n)]
            after = start ^ _rotated(entry(place), turn + 1, n), (turn + direction(place) + 1) % n
            table.append((after[0] * n + after[1]) << n | place)
    return table


def curve_index(coordinates: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve (bigint) of a point with coordinates 0 .. 2 ** ``bits`` - 1.

    At most 63 bits in all, and 4 dimensions (the table has n * 4 ** n entries).
    """
    n = len(coordinates)
    if not 1 <= n <= 4 or n * bits > 63:
        raise ValueError("a curve has 1 to 4 dimensions and at most 63 bits")
    table = F.array(*map(F.lit, curve_table(n)))
    state, index = F.lit(0), F.lit(0).cast("bigint")
    for level in reversed(range(bits)):
        corner = F.lit(0)
        for i, c in enumerate(coordinates):
            corner = corner + F.shiftleft(F.shiftright(c, level).bitwiseAND(1), i)
        step = F.get(table, F.shiftleft(state, n) + corner)
        state = F.shiftright(step, n)
        index = F.shiftleft(index, n) + step.bitwiseAND((1 << n) - 1)
    return index


def _offsets(sizes: DataFrame, part: str, n: str) -> Column:
    """A scalar map from a partition to the sum of ``n`` over those before it (a row a partition of a shuffle)."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(part).alias("part"), F.col(n).alias("n"))))
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<struct<part:int,before:bigint>>").alias("out"))
    folded = F.aggregate(listed, start, lambda acc, x: F.struct(
        (acc["sum"] + x["n"]).alias("sum"),
        F.concat(acc["out"], F.array(F.struct(x["part"].alias("part"), acc["sum"].alias("before")))).alias("out")), lambda acc: acc["out"])
    return sizes.agg(F.map_from_entries(folded).alias("before")).scalar()


def coordinate_splits(df: DataFrame, dimension: str, bits: int) -> Column:
    """A scalar array: for each coordinate in use, the smallest value that has it (at most ``2 ** bits`` entries).

    The rows before a value are counted over the sorted distinct values, in ranges whose totals are
    added up afterwards.
    """
    value = quoted(dimension)
    histogram = df.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = checkpoint(histogram.repartitionByRange("v").sortWithinPartitions("v"))
    ranged = ranged.withColumn("part", F.spark_partition_id())
    sizes = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1))
    total = sizes.agg(F.sum("n")).scalar()
    before = F.coalesce(inside, F.lit(0)) + F.element_at(_offsets(sizes, "part", "n"), F.col("part"))
    share = ranged.select("v", F.floor(before.cast("decimal(38,0)") * (1 << bits) / total).cast("int").alias("c"))
    firsts = share.groupBy("c").agg(F.min(F.struct(F.col("v").isNotNull().alias("some"), "v")).alias("first"))
    return firsts.agg(F.array_sort(F.collect_list(F.struct("first", "c")))).scalar()


def coordinate(value: Column, splits: Column, bits: int) -> Column:
    """The coordinate of a value: that of the last split not above it (binary search)."""
    here = F.struct(value.isNotNull().alias("some"), value.alias("v"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits + 1))])
    last = F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(splits, at + step)["first"] <= here, at + step).otherwise(at))
    return F.get(splits, last)["c"]


def shards(df: DataFrame, dimensions: Sequence[str], n_shards: int, bits: int = BITS,
           name: str = "placed") -> tuple[DataFrame, str]:
    """``df`` with a struct ``index`` (place on the curve), ``shard`` and ``slot`` (both from 0), and its name.

    Sizes of shards differ by at most one row, shard i holds the rows before those of shard i + 1, slots follow the curve.
    """
    name = temporary_name(df, name)
    columns = df.columns
    index, copy, at, splits = (temporary_name(df, c) for c in ("curve_index", "copy_number", "curve_at", "curve_splits"))
    found = df
    for i, d in enumerate(dimensions):  # the splits as columns: a lambda cannot hold a subquery
        found = found.withColumn(f"{splits}{i}", coordinate_splits(df, d, bits))
    places = [coordinate(quoted(d), F.col(f"{splits}{i}"), bits) for i, d in enumerate(dimensions)]
    placed = found.select(*map(quoted, columns), *[p.alias(f"{splits}{i}") for i, p in enumerate(places)])
    placed = placed.select(*map(quoted, columns), curve_index([F.col(f"{splits}{i}") for i in range(len(dimensions))], bits).alias(index))
    # equal rows are numbered, so that no run of the curve is too long to split
    unique = numbered_copies(placed, copy)
    order = [F.col(index), *map(quoted, columns), F.col(copy)]
    ranged = checkpoint(unique.repartitionByRange(*order).sortWithinPartitions(*order))
    part = F.spark_partition_id()
    counted = ranged.select(part.alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    row = F.monotonically_increasing_id().bitwiseAND(_ROW_MASK)
    total = F.coalesce(counted.agg(F.sum("n")).scalar(), F.lit(0))
    numbered = ranged.withColumn(at, F.element_at(_offsets(counted, "part", "n"), part) + row)
    # decimals: a place times the number of shards may pass a long
    shard = F.floor(F.col(at).cast("decimal(38,0)") * n_shards / total).cast("int")
    first = F.ceil(shard.cast("decimal(38,0)") * total / n_shards).cast("bigint")
    struct = F.struct(F.col(index).alias("index"), shard.alias("shard"), (F.col(at) - first).cast("bigint").alias("slot"))
    return numbered.select(*map(quoted, columns), struct.alias(name)), name


def shard_ranges(placed: DataFrame, name: str, dimensions: Sequence[str]) -> DataFrame:
    """What a reader needs to skip shards: ``shard``, ``rows``, and ``min_<d>``, ``max_<d>`` of each dimension."""
    bounds = [f(quoted(d)).alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]
    return placed.groupBy(F.col(name)["shard"].alias("shard")).agg(F.count(F.lit(1)).alias("rows"), *bounds)


def write_shards(placed: DataFrame, name: str, path: str, tasks: int) -> None:
    """One folder ``shard=i`` a shard, each written by several of ``tasks`` tasks, rows in the order of their slots."""
    rows = placed.withColumn("shard", F.col(name)["shard"]).withColumn("slot", F.col(name)["slot"]).drop(name)
    ranged = rows.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
