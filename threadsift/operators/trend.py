"""Word-by-period matrices and their merge.

Token counts are pivoted into a wide ``word x period`` table (explicit pivot
values, so Spark runs no job to discover them); the rows with the highest
totals are its top N, in the same plan, and the matrices of several groups of
periods meet in a full outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def period_column_name(period: str) -> str:
    """``2023-Q1`` -> ``y2023_q1`` (a plain identifier in every SQL dialect)."""
    return "y" + period.lower().replace("-", "_")


def wide_counts(counts: DataFrame, periods: Sequence[str]) -> DataFrame:
    """A14 for every word: ``word`` plus one bigint column per period (0 when absent).

    One pivot aggregate with explicit values.
    """
    counts = counts.where(F.col("period").isin(list(periods)))
    wide = counts.groupBy("word").pivot("period", list(periods)).agg(F.sum("freq"))
    wide = wide.na.fill(0, subset=list(periods))
    return wide.select("word", *[F.col(f"`{p}`").cast("bigint").alias(period_column_name(p)) for p in periods])


def top_rows(wide: DataFrame, periods: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows of a wide matrix with the highest total (ties by word); at most ``n`` rows reach the driver."""
    cols = [F.col(period_column_name(p)) for p in periods]
    total = sum(cols[1:], cols[0])
    return wide.where(total > 0).orderBy(total.desc(), "word").limit(n)


def word_period_matrix(counts: DataFrame, periods: Sequence[str], n: int = 10,
                       words: Sequence[str] | None = None) -> DataFrame:
    """One row per chosen word, one bigint column per period (0 when absent).

    ``counts`` has ``period, word, freq``. Without ``words`` the chosen words
    are the ``n`` most frequent over the given periods.
    """
    wide = wide_counts(counts, periods)
    return wide.where(F.col("word").isin(list(words))) if words is not None else top_rows(wide, periods, n)


def split_trend(counts: DataFrame, halves: Sequence[Sequence[str]], n: int = 10) -> DataFrame:
    """One matrix per group of periods, each over its own top words,
    merged on the word by full outer joins with gaps filled by 0.

    The period filter of a group reaches the scan, so the groups share the
    token work between them; only ``n`` rows per group meet in the join.
    """
    merged = None
    for half in halves:
        matrix = word_period_matrix(counts, half, n)
        merged = matrix if merged is None else merge_matrices(merged, matrix)
    return merged


def merge_matrices(left: DataFrame, right: DataFrame, key: str = "word") -> DataFrame:
    """Full outer join of two matrices on the word; gaps become 0."""
    merged = left.join(right, key, "full_outer")
    value_cols = [c for c in merged.columns if c != key]
    return merged.na.fill(0, subset=value_cols)
