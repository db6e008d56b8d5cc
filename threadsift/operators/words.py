"""Hot words: tokenise, drop stop words, count, rank.

Plan shape: a narrow stage explodes tokens and filters stop words with an
``InSet`` predicate; counting is a hash aggregate with map-side partial
aggregation, so a very frequent word or a source holding a third of the rows
only ships one partial count per map task. Top-N per group is a
``row_number`` filter, which Spark plans as ``WindowGroupLimit`` so only the
N best rows per group and map task cross the shuffle. Overall and
per-period counts come from one ``GROUPING SETS`` aggregate over the counts
per source, period and word (one scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.text import hot_word_tokens
from threadsift.operators.stopwords import default_stop_words

OVERALL = "overall"


def word_tokens(df: DataFrame, text_col: str = "text", keys: Sequence[str] = (),
                stop_words: Sequence[str] | None = None,
                split_fused: bool = True) -> DataFrame:
    """One row per kept token: ``keys..., word``."""
    stop = default_stop_words() if stop_words is None else list(stop_words)
    tokens = df.select(*keys, F.explode(hot_word_tokens(F.col(text_col), split_fused)).alias("word"))
    if stop:
        tokens = tokens.where(~F.col("word").isin(stop))
    return tokens


def word_counts(tokens: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys..., word, freq`` (freq is a bigint)."""
    return tokens.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("freq"))


def rank_within(df: DataFrame, group_keys: Sequence[str], n: int,
                order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the ``n`` best rows per group, with a ``rank`` column.

    Ties on frequency are broken by the word, ascending, so the result is
    deterministic.
    """
    order = order or [F.col("freq").desc(), F.col("word").asc()]
    if not group_keys:
        return top_n(df, n, order)
    w = Window.partitionBy(*group_keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_n(df: DataFrame, n: int, order: Sequence[Column] | None = None) -> DataFrame:
    """Global top ``n`` with a ``rank`` column.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: every task
    keeps its best ``n`` rows, so nothing unbounded reaches one task. The
    rank window then runs over at most ``n`` rows.
    """
    order = order or [F.col("freq").desc(), F.col("word").asc()]
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def hot_words(df: DataFrame, text_col: str = "text", group_keys: Sequence[str] = (),
              n: int = 10, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Top ``n`` words per group: ``group_keys..., word, freq, rank``."""
    counts = word_counts(word_tokens(df, text_col, group_keys, stop_words), group_keys)
    return rank_within(counts, group_keys, n)


def hot_words_levels(df: DataFrame, text_col: str, source_col: str, period_col: str,
                     n: int = 10, stop_words: Sequence[str] | None = None,
                     drop_null_periods: bool = False) -> DataFrame:
    """Overall and per-period top words in one pass.

    Output ``source, period, word, freq, rank`` where ``period`` is
    ``'overall'`` for the whole source. Rows without a period count in the
    overall level; ``drop_null_periods`` leaves out their per-period group.
    """
    keys = [source_col, period_col]
    counted = word_counts(word_tokens(df, text_col, keys, stop_words), keys)
    # the grouping sets expand counts, not tokens
    counts = counted.groupingSets(
        [[source_col, "word"], [source_col, period_col, "word"]],
        source_col, period_col, "word",
    ).agg(F.sum("freq").alias("freq"), F.grouping_id().alias("_level"))
    counts = counts.select(
        F.col(source_col).alias("source"),
        F.when(F.col("_level") > 0, F.lit(OVERALL)).otherwise(F.col(period_col)).alias("period"),
        "word", "freq",
    )
    if drop_null_periods:
        counts = counts.where(F.col("period").isNotNull())
    return rank_within(counts, ["source", "period"], n)


def hot_word_reports(posts: DataFrame, time_col: str, text_col: str, source_col: str,
                     quarter_sources: Sequence[str] = (), era_sources: Sequence[str] = (),
                     n: int = 10) -> DataFrame:
    """X5 end to end: top words per source overall, and per quarter or era for
    the sources that ask for it, in one grouping-sets pass.

    ``time_col`` is text whose first ten characters are a date. Sources in
    neither list get the overall list only; rows with an unreadable date
    count overall but in no period.
    """
    from threadsift.functions.text import date_prefix, era_label, quarter_label

    d = date_prefix(time_col)
    src = F.col(source_col)
    period = (F.when(src.isin(list(quarter_sources)), quarter_label(d))
              .when(src.isin(list(era_sources)), era_label(d)))
    tagged = posts.select(src.alias(source_col), F.col(text_col).alias(text_col), period.alias("_period"))
    return hot_words_levels(tagged, text_col, source_col, "_period", n, drop_null_periods=True)


def report_lines(ranked: DataFrame, source_col: str = "source",
                 period_col: str = "period") -> DataFrame:
    """SNK5 body: one ``word: freq`` line per ranked row, with its file keys."""
    return ranked.select(
        source_col, period_col, "rank",
        F.format_string("%s: %d", F.col("word"), F.col("freq")).alias("line"),
    )
