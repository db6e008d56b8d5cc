"""Column profiles and quality counters.

A profile's counters are one aggregate over the table, evaluated in a single
scan with map-side partial aggregation and then turned into long form
(``metric``/``column``, ``value``). Distributions are a second aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col
from threadsift.functions.predicates import is_filled, is_missing
from threadsift.operators.quantiles import histogram_quantiles, value_histogram
from threadsift.functions.text import is_all_digits, is_int, is_valid_datetime, length_or_zero, try_int


# Integers of up to 38 digits keep their value.
WIDE = "decimal(38,0)"


def keyset_equals(json_col, expected: Sequence[str]) -> Column:
    """The JSON object's key set equals ``expected`` (order-free)."""
    keys = F.array_sort(F.json_object_keys(as_col(json_col)))
    want = F.array_sort(F.array(*[F.lit(k) for k in expected]))
    return F.coalesce(keys == want, F.lit(False))


def _long_form(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    return one_row.unpivot([], list(names), key, value)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: filled / total per column (whitespace counts as filled)."""
    aggs = [F.avg(F.when(is_filled(c), 1.0).otherwise(0.0)).alias(c) for c in columns]
    return _long_form(df.agg(*aggs), columns, "column", "ratio")


def missing_counts(df: DataFrame, columns: Sequence[str], rule=None,
                   keep_zero: bool = False) -> DataFrame:
    """Rows per column that are missing under ``rule``.

    The default rule is "null, empty or whitespace only"; pass
    ``predicates.is_missing`` for the null/blank/``-``/``null`` rule. Columns
    with no missing value are left out unless ``keep_zero``.
    """
    rule = rule or _is_blank
    aggs = [F.count_if(rule(c)).alias(c) for c in columns]
    out = _long_form(df.agg(*aggs), columns, "column", "missing")
    return out if keep_zero else out.where(F.col("missing") > 0)


def category_distribution(df: DataFrame, id_col: str, time_col: str, kind_col: str) -> DataFrame:
    """A4: value counts of id type, time validity and the kind column.

    Output ``metric, category, n``. One grouping-sets aggregate: the three
    distributions share a single scan and shuffle.
    """
    typed = df.select(
        F.when(is_all_digits(id_col), "numeric").otherwise("non_numeric").alias("type_id"),
        F.when(is_valid_datetime(time_col), "datetime").otherwise("invalid_datetime").alias("type_time"),
        as_col(kind_col).alias("type_distribution"),
    )
    counts = typed.groupingSets(
        [["type_id"], ["type_time"], ["type_distribution"]],
        "type_id", "type_time", "type_distribution",
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    # grouping_id bits: type_id=4, type_time=2, type_distribution=1 (set = aggregated away)
    return counts.select(
        F.when(F.col("_g") == 3, "type_id").when(F.col("_g") == 5, "type_time")
        .otherwise("type_distribution").alias("metric"),
        F.when(F.col("_g") == 3, F.col("type_id")).when(F.col("_g") == 5, F.col("type_time"))
        .otherwise(F.col("type_distribution")).alias("category"),
        "n",
    )


def discrete_percentiles(values: DataFrame, col: str, probs: Sequence[float],
                         keys: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles (linear interpolation) of an integer-valued column.

    Works on the value histogram (see ``quantiles``), so the raw values are
    never gathered in one task. Output ``keys..., p<k>`` columns as doubles.
    """
    return histogram_quantiles(value_histogram(values, col, keys), probs, keys, "p")


def length_profile(df: DataFrame, text_col: str, keys: Sequence[str] = (),
                   probs: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Count, min, max, mean and exact percentiles of text length."""
    if not keys:
        return length_profile(df.withColumn("_all", F.lit(0)), text_col, ["_all"], probs).drop("_all")
    lengths = df.select(*keys, length_or_zero(text_col).alias("_len"))
    summary = lengths.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_len").alias("min_len"),
        F.max("_len").alias("max_len"), F.round(F.avg("_len"), 6).alias("avg_len"),
    )
    pct = discrete_percentiles(lengths, "_len", probs, keys)
    return summary.join(pct, list(keys))


def length_histogram(df: DataFrame, text_col: str, bucket: int, keys: Sequence[str] = ()) -> DataFrame:
    """A5 histogram: rows per length bucket of width ``bucket``."""
    b = (F.floor(length_or_zero(text_col) / bucket) * bucket).cast("bigint").alias("bucket")
    return df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("n"))


def invalid_type_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, values present (P8 rule) that are not integers."""
    aggs = [F.count_if(~is_missing(c) & ~is_int(c)).alias(c) for c in columns]
    return _long_form(df.agg(*aggs), columns, "column", "invalid").where(F.col("invalid") > 0)


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    """Count of valid integers and their mean rounded to 2 decimals (empty if none)."""
    v = try_int(F.when(~is_missing(col), as_col(col)), WIDE)
    out = df.agg(F.count(v).alias("n_valid"), F.round(F.avg(v.cast("double")), 2).alias("avg_value"))
    return out.where(F.col("n_valid") > 0)


def numeric_histogram(df: DataFrame, col: str) -> DataFrame:
    """Rows per valid integer value."""
    v = try_int(F.when(~is_missing(col), as_col(col)), WIDE).alias("value")
    return df.select(v).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def counters(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Named counters summed in one pass, long form ``metric, value``.

    Flags (booleans) count their true rows; numeric measures are summed.
    Sums are 64-bit, so large tables cannot overflow as 32-bit sums do.
    """
    aggs = [F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long")).alias(n) for n, c in named.items()]
    return _long_form(df.agg(*aggs), list(named), "metric", "value")


def _is_blank(c) -> Column:
    return as_col(c).isNull() | (F.trim(F.regexp_replace(as_col(c), r"(?U)\s", " ")) == "")


def _rows(one_row: DataFrame, fields: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """The cells of a one-row aggregate as rows: ``rows`` are (label, label, value name)."""
    cells = [F.struct(F.lit(a).cast("string").alias(fields[0]), F.lit(b).cast("string").alias(fields[1]),
                      F.col(f"`{c}`").cast("double").alias(fields[2])) for a, b, c in rows]
    return one_row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def news_profile_report(df: DataFrame, columns: Sequence[str], id_col: str = "id", time_col: str = "time",
                        kind_col: str = "type", text_col: str = "text") -> DataFrame:
    """X11: the full profile of a news table as ``metric, category, value`` rows.

    ``completeness_<col>``, ``type_id``/``type_time``/``type_distribution``
    per category, ``missing_<col>`` (non-zero only) and ``text_length``
    statistics (count, min, max, mean, median, 90th percentile) instead of
    the raw length list. Two passes: one row of counters, and one
    grouping-sets aggregate for the distributions and the length histogram.
    """
    length = length_or_zero(text_col)
    one = df.agg(
        *[F.avg(F.when(is_filled(c), 1.0).otherwise(0.0)).alias(f"filled {c}") for c in columns],
        *[F.count_if(_is_blank(c)).alias(f"missing {c}") for c in columns],
        F.count(F.lit(1)).alias("n"), F.min(length).alias("min_len"), F.max(length).alias("max_len"),
        F.round(F.avg(length), 6).alias("avg_len"))
    stats = ("n", "min_len", "max_len", "avg_len")
    fields = ("metric", "category", "value")
    cells = _rows(one, fields, [(f"completeness_{c}", None, f"filled {c}") for c in columns]
                  + [(f"missing_{c}", None, f"missing {c}") for c in columns]
                  + [("text_length", s, s) for s in stats])
    cells = cells.where(~F.col("metric").startswith("missing_") | (F.col("value") > 0))

    typed = df.select(
        F.when(is_all_digits(id_col), "numeric").otherwise("non_numeric").alias("type_id"),
        F.when(is_valid_datetime(time_col), "datetime").otherwise("invalid_datetime").alias("type_time"),
        as_col(kind_col).alias("type_distribution"), length.alias("len"))
    names = ["type_id", "type_time", "type_distribution", "len"]
    # grouping_id: the bit of each column that is aggregated away, first column highest
    sets = {name: 15 - (8 >> i) for i, name in enumerate(names)}
    counts = typed.groupingSets([[n] for n in names], *names).agg(
        F.count(F.lit(1)).alias("n"),
        # with an aggregate in it, so that filters on the set stay above and both uses share one pass
        (F.grouping_id() + F.max(F.lit(0))).alias("_set"))
    of = lambda name: F.col("_set") == sets[name]
    cats = counts.where(~of("len")).select(
        F.when(of("type_id"), "type_id").when(of("type_time"), "type_time").otherwise("type_distribution").alias("metric"),
        F.when(of("type_id"), F.col("type_id")).when(of("type_time"), F.col("type_time"))
        .otherwise(F.col("type_distribution")).alias("category"),
        F.col("n").cast("double").alias("value"))
    hist = counts.where(of("len")).select(F.col("len").cast("double").alias("_v"), F.col("n").alias("_n"))
    quantiles = histogram_quantiles(hist, (0.5, 0.9), [], "p")
    lengths = _rows(quantiles, fields, [("text_length", q, q) for q in ("p50", "p90")])
    return cells.unionByName(cats).unionByName(lengths)


def qa_profile_report(df: DataFrame, columns: Sequence[str], score_col: str = "Score") -> DataFrame:
    """The profile of a 13-column Q&A table as ``tag, field, value`` rows.

    ``MISSING`` per column (null/blank/``-``/``null`` rule, non-zero only),
    ``INVALID_TYPE`` for a score that is present but not an integer,
    ``AVERAGE_SCORE`` (2 decimals, only when there is a valid score) and
    ``SCORE_DISTRIBUTION`` per integer score. Two passes: one row of counters,
    and the histogram of scores.
    """
    present = ~is_missing(score_col)
    one = df.agg(
        *[F.count_if(is_missing(c)).alias(f"missing {c}") for c in columns],
        F.count_if(present & ~is_int(score_col)).alias("invalid"),
        F.round(F.avg(try_int(F.when(present, as_col(score_col)), WIDE).cast("double")), 2).alias("mean"))
    fields = ("tag", "field", "value")
    cells = _rows(one, fields, [("MISSING", c, f"missing {c}") for c in columns]
                  + [("INVALID_TYPE", score_col, "invalid"), ("AVERAGE_SCORE", None, "mean")])
    cells = cells.where(F.when(F.col("tag") == "AVERAGE_SCORE", F.col("value").isNotNull()).otherwise(F.col("value") > 0))
    dist = numeric_histogram(df, score_col).select(
        F.lit("SCORE_DISTRIBUTION").alias("tag"), F.col("value").cast("string").alias("field"),
        F.col("n").cast("double").alias("value"))
    return cells.unionByName(dist)


def error_samples(bad: DataFrame, n: int = 20, error_col: str = "error", raw_col: str = "raw") -> DataFrame:
    """Per error kind, the row count and up to ``n`` raw examples.

    The examples are cut to ``n`` per kind by a ``row_number`` filter
    (partial ``WindowGroupLimit`` before the shuffle) before ``collect_list``,
    so no group buffer grows with the data. Output ``error, n, examples``.
    """
    counts = bad.groupBy(error_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(error_col).orderBy(F.xxhash64(raw_col), F.col(raw_col))
    firsts = bad.select(error_col, raw_col).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    examples = firsts.groupBy(error_col).agg(F.collect_list(raw_col).alias("examples"))
    return counts.join(examples, error_col)
