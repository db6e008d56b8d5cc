"""Exact and prefix de-duplication.

"Keep the first row per key" is a ``row_number() = 1`` filter. Spark plans it
with ``WindowGroupLimit`` on both sides of the shuffle, so each map task
sends at most one row per key: a key shared by a third of all rows (for
example every body too short to reach a slice, which all share the empty
slice) costs one row per task in the shuffle, not a third of the table in
one task.

The cascade applies one such filter per slice, each on the survivors of the
previous one; the steps cannot be merged because a row removed by an early
step must not win a later one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col


def first_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order`` (make ``order`` unique for determinism)."""
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row distinct (hash aggregate with partial aggregation)."""
    return (df.select(*columns) if columns else df).distinct()


def slice_key(col, start: int, length: int, row_id, short_text: str = "collapse") -> Column:
    """Key of a prefix slice ``substr(col, start, length)``.

    ``short_text="collapse"`` keeps the source behaviour: texts shorter than
    ``start`` all share the empty slice and compete for one survivor.
    ``"keep"`` gives each of them its own key, so all are kept.
    """
    piece = F.substring(as_col(col), start, length)
    if short_text == "collapse":
        return piece
    if short_text != "keep":
        raise ValueError("short_text must be 'collapse' or 'keep'")
    short = F.coalesce(piece == "", F.lit(True))
    return F.struct(short.alias("short"),
                    F.when(short, as_col(row_id).cast("string")).otherwise(piece).alias("v"))


def prefix_dedupe(df: DataFrame, col, start: int, length: int, order: Sequence[Column],
                  row_id="id", short_text: str = "collapse") -> DataFrame:
    """One row per text slice, the first under ``order``."""
    return first_per_key(df, [slice_key(col, start, length, row_id, short_text)], order)


def cascade_dedupe(df: DataFrame, slices: Sequence[tuple[str, int, int]], order: Sequence[Column],
                   row_id="id", short_text: str = "collapse") -> DataFrame:
    """Apply ``prefix_dedupe`` for each ``(column, start, length)`` in turn."""
    for col, start, length in slices:
        df = prefix_dedupe(df, col, start, length, order, row_id, short_text)
    return df
