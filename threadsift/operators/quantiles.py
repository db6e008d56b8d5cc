"""Exact quantiles, running counts and AUC without sorting a table as a whole.

A table is first reduced to one row per distinct value (a partial aggregate,
so a value shared by a third of the rows costs one row per task). Distinct values are
dealt to 1,024 buckets whose splits are approximate quantiles of the distinct values,
held as one scalar subquery of the plan, so values crowded into a narrow range spread
as well as any, and nothing runs before an action. The totals of the buckets tell
in which of them a wanted rank lies: a quantile sorts the values of those buckets only. AUC
needs every value's rank, but only within its bucket, plus one product of totals a bucket.
Values keep their type: integers beyond 2**53 stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def with_bucket(distinct: DataFrame, value_col: str, out_col: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds bucket 0 .. ``buckets`` - 1 of a value: the number of splits at or below it (monotone)."""
    shares = [i / buckets for i in range(1, buckets)]
    splits = distinct.agg(F.percentile_approx(F.col(value_col).cast("double"), shares, 10 * buckets)).scalar()
    steps = [1 << i for i in reversed(range((buckets - 1).bit_length()))]
    value = F.col(value_col).cast("double")
    # binary search: a step is taken if the split it leads to is not above the value
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(F.col("_splits"), at + step - 1) <= value, at + step).otherwise(at))
    return distinct.withColumn("_splits", splits).withColumn(out_col, F.coalesce(found, F.lit(0))).drop("_splits")


def value_histogram(df: DataFrame, value_col: str, keys: Sequence[str]) -> DataFrame:
    """``keys..., _v, _n``: rows per distinct value (nulls left out)."""
    rows = df.where(F.col(value_col).isNotNull())
    return rows.groupBy(*keys, F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def _totals(bucketed: DataFrame, keys: Sequence[str], **sums: Column) -> DataFrame:
    """``keys..., _b``, sums, and ``_before_<sum>``: totals of a key's buckets and of all its buckets before."""
    totals = bucketed.groupBy(*keys, "_b").agg(*[c.alias(n) for n, c in sums.items()])
    # at most BUCKETS rows per key
    upto = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.withColumns({f"_before_{n}": F.sum(n).over(upto) - F.col(n) for n in sums})


def histogram_quantiles(hist: DataFrame, probs: Sequence[float], keys: Sequence[str], prefix: str = "q") -> DataFrame:
    """Exact quantiles (linear interpolation) of a ``value_histogram``: ``keys..., q<p>``.

    The smallest and largest value (0 and 1) keep their type, others are doubles.
    """
    keys = list(keys)
    bucketed = with_bucket(hist, "_v", "_b")
    totals = _totals(bucketed, keys, _size=F.sum("_n"))
    total = F.sum("_size").over(Window.partitionBy(*keys))
    places = {f"{part}{i}": f(F.lit(p) * (total - 1)).cast("bigint") for i, p in enumerate(probs)
              for part, f in (("_a", F.floor), ("_c", F.ceil))}
    totals = totals.withColumns({"_total": total} | places)
    here = [(F.col(c) >= F.col("_before__size")) & (F.col(c) < F.col("_before__size") + F.col("_size")) for c in places]
    wanted = here[0]
    for c in here[1:]:
        wanted = wanted | c
    # at most 2 buckets a wanted quantile and key: only their values are sorted
    inside = bucketed.join(totals.where(wanted).drop("_size"), [*keys, "_b"])
    before = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_hi", F.col("_before__size") + F.sum("_n").over(before))
    covers = lambda c: (F.col(c) >= F.col("_hi") - F.col("_n")) & (F.col(c) < F.col("_hi"))
    picked = ranked.groupBy(*keys).agg(*[F.max(F.when(covers(c), F.col("_v"))).alias(c) for c in places], F.max("_total").alias("_total"))
    out = [F.col(k) for k in keys]
    for i, p in enumerate(probs):
        low, high, place = F.col(f"_a{i}"), F.col(f"_c{i}"), F.lit(p) * (F.col("_total") - 1)
        value = low if p in (0, 1) else low.cast("double") + (high - low).cast("double") * (place - F.floor(place))
        out.append(value.alias(prefix + format(p * 100, "g").replace(".", "_")))
    return picked.select(*out)


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of ``value_col`` per key: ``keys..., q<p>``."""
    return histogram_quantiles(value_histogram(df, value_col, keys), probs, keys)


def roc_auc(df: DataFrame, score_col: str, label_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys..., roc_auc`` (ties count one half; null without both classes; without keys one row).

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2), divided by the
    number of pairs. The negatives below s are those of the buckets before, and those before s in its bucket.
    """
    keys = list(keys)
    ties = df.groupBy(*keys, F.col(score_col).alias("_v")).agg(
        F.count_if(F.col(label_col) == 1).alias("_pos"), F.count_if(F.col(label_col) != 1).alias("_neg"))
    bucketed = with_bucket(ties, "_v", "_b")
    before = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    less = F.sum("_neg").over(before) - F.col("_neg") / 2
    ranked = bucketed.withColumn("_wins", F.col("_pos") * less)
    totals = _totals(ranked, keys, _p=F.sum("_pos"), _n=F.sum("_neg"), _w=F.sum("_wins"))
    wins = F.sum(F.col("_w") + F.col("_p") * F.col("_before__n").cast("double"))
    pairs = F.sum("_p").cast("double") * F.sum("_n")
    return totals.groupBy(*keys).agg(F.try_divide(wins, pairs).alias("roc_auc"))
