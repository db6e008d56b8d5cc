"""Total-order sort and key-ordered reports.

Range partitioning replaces the sampled partition file + total-order
partitioner: Spark samples the key per input partition
(``spark.sql.execution.rangeExchange.sampleSizePerPartition``) while planning
the exchange, so there is no client-side sampling barrier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.operators.copies import free_names, numbered_copies, quoted


def range_partitioned(df: DataFrame, num_ranges: int | None, *keys) -> DataFrame:
    """Key ranges: as many as asked for, else as many as the session's shuffle partitions."""
    n = [] if num_ranges is None else [num_ranges]
    return df.repartitionByRange(*n, *[F.col(k) if isinstance(k, str) else k for k in keys])


def range_sorted(df: DataFrame, key: str | Column, num_ranges: int | None = None) -> DataFrame:
    """O1: key ranges, each sorted by key; file ``i`` <= file ``i+1``.

    Equal rows are counted, numbered and made again (``copies.numbered_copies``), and ranges are
    cut on (key, hash of the row, number): rows of one very frequent key, or copies of one row,
    spread over adjacent ranges instead of filling one task; the key order across and within
    ranges is unchanged (duplicates kept). Boundaries are sampled from the shuffled
    counts, so the plan above runs once.
    """
    number, = free_names(df, "number")
    order = [F.col(key) if isinstance(key, str) else key, F.xxhash64(*map(quoted, df.columns)), F.col(number)]
    ranged = range_partitioned(numbered_copies(df, number), num_ranges, *order)
    return ranged.sortWithinPartitions(*order).drop(number)


def sorted_report(df: DataFrame, *keys: str) -> DataFrame:
    """Explicit order where a report needs it (small outputs only)."""
    return df.orderBy(*keys)
