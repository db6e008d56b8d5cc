"""Rows that repeat: counted, numbered and repeated without one task per value.

Equal rows cannot be told apart by any function of their columns, so a sort or a hash
puts all of them into one task. Here equal rows are first counted (a
partial aggregate: a row that a third of the table repeats crosses the shuffle once a
task) and then numbered 0, 1, 2, ... inside their group while they are made
again; groups of more than ``CHUNK`` copies are first cut into chunks that are dealt over
all tasks. The number makes every row distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies that one task makes of a row at a time.
CHUNK = 1 << 14


def quoted(name: str) -> Column:
    """A column by its exact name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores in front until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def run_lengths(df: DataFrame, copies: str) -> DataFrame:
    """Each distinct row once, with the number of its copies in column ``copies``.

    Nulls are equal to each other; so are 0.0 and -0.0. Columns of type map cannot be compared.
    """
    return df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias(copies))


def repeated(runs: DataFrame, copies: str, occurrence: str, chunk: int = CHUNK) -> DataFrame:
    """Every row ``copies`` times, numbered 0 .. ``copies`` - 1 in column ``occurrence``; ``copies`` goes.

    Rows without copies (0 or null) go. Only rows of more than ``chunk`` copies cross a shuffle,
    once a chunk.
    """
    keep = [quoted(c) for c in runs.columns if c != copies]
    n = quoted(copies)
    few = runs.where((n > 0) & (n <= chunk)).select(*keep, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias(occurrence))
    first, last = free_names(runs, "chunk_start", "chunk_end")
    starts = runs.where(n > chunk).select(
        *keep, (n - 1).alias(last), F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk).cast("bigint"))).alias(first))
    # a fixed number of partitions: chunks are small in bytes, so adaptive execution would pack them together
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = starts.repartition(tasks, F.col(first), F.xxhash64(*keep))
    many = dealt.select(*keep, F.explode(F.sequence(
        F.col(first), F.least(F.col(first) + (chunk - 1), F.col(last)))).alias(occurrence))
    return few.unionByName(many)


def numbered_copies(df: DataFrame, occurrence: str) -> DataFrame:
    """``df`` with each row's number among its equals (0, 1, ...) in column ``occurrence``."""
    copies, = free_names(df, "copies")
    return repeated(run_lengths(df, copies), copies, occurrence)
