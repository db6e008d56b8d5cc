"""Hot-word, grouping-set, pivot and trend queries on ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.functions.text import FUSED_WORDS, date_prefix, era_label, quarter_label
from threadsift.operators import trend, words
from threadsift.operators.stopwords import default_stop_words, stop_words_frame
from threadsift.plans.adapters import (
    ERA_DAYS, ERA_START, QUARTER_DAYS, QUARTER_START, SQL_ERA_TIME, SQL_QUARTER_TIME,
    documents_with_time,
)
from threadsift.plans.registry import register, sql_list
from threadsift.plans.tables import table

TOP_N = 10
QUARTERS_2023 = ["2023-Q1", "2023-Q2", "2023-Q3", "2023-Q4"]
QUARTERS_2024 = ["2024-Q1", "2024-Q2", "2024-Q3", "2024-Q4"]


def _docs_quarter(spark, sf_dir) -> DataFrame:
    docs = documents_with_time(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]), QUARTER_START, QUARTER_DAYS)
    return docs.withColumn("period", quarter_label(date_prefix("time")))


def _docs_era(spark, sf_dir) -> DataFrame:
    docs = documents_with_time(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]), ERA_START, ERA_DAYS)
    return docs.withColumn("period", era_label(date_prefix("time")))


# --- SQL building blocks (DuckDB) -----------------------------------------
_SQL_STOP = sql_list(default_stop_words())


def _sql_fused(expr: str) -> str:
    for a, b in FUSED_WORDS:
        expr = f"regexp_replace({expr}, '\\b{a}{b}\\b', '{a} {b}', 'g')"
    return expr


_SQL_CLEAN = _sql_fused("regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g')")


def _sql_tokens(cols: str, source: str = "documents") -> str:
    """CTE body: ``cols, word`` for every kept token."""
    return (
        f"SELECT {cols}, word FROM (SELECT {cols}, "
        f"unnest(string_split_regex({_SQL_CLEAN}, '\\s+')) AS word FROM {source}) t "
        f"WHERE word <> '' AND word NOT IN {_SQL_STOP}"
    )


_SQL_QUARTER = (
    "CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR)"
)
_SQL_ERA = (
    "CASE WHEN year(d) BETWEEN 2007 AND 2010 THEN '2007-2010' "
    "WHEN year(d) BETWEEN 2011 AND 2015 THEN '2011-2015' "
    "WHEN year(d) BETWEEN 2016 AND 2020 THEN '2016-2020' ELSE '2021-2024' END"
)


def _sql_docs_period(time_expr: str, label_expr: str) -> str:
    return (
        f"(SELECT doc_id, source, text, {label_expr} AS period FROM ("
        f"SELECT doc_id, source, text, CAST(try_strptime(substr({time_expr}, 1, 10), '%Y-%m-%d') AS DATE) AS d "
        f"FROM documents) x)"
    )


def _sql_top(keys: str, counts: str) -> str:
    return (
        f"SELECT {keys}, word, freq, rank FROM (SELECT {keys}, word, freq, "
        f"CAST(row_number() OVER (PARTITION BY {keys} ORDER BY freq DESC, word ASC) AS INTEGER) AS rank "
        f"FROM ({counts}) c) r WHERE rank <= {TOP_N}"
    )


def _sql_counts(keys: str, tokens: str) -> str:
    return f"SELECT {keys}, word, CAST(count(*) AS BIGINT) AS freq FROM ({tokens}) k GROUP BY {keys}, word"


# --- queries ----------------------------------------------------------------

@register("hot_words_overall", _sql_top("source", _sql_counts("source", _sql_tokens("source"))))
def hot_words_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["source", "text"])
    return words.hot_words(docs, "text", ["source"], TOP_N)


@register("hot_words_global", f"""
SELECT word, freq, CAST(row_number() OVER (ORDER BY freq DESC, word) AS INTEGER) AS rank FROM (
  SELECT word, CAST(count(*) AS BIGINT) AS freq FROM ({_sql_tokens('source')}) k GROUP BY word) c
ORDER BY rank LIMIT {TOP_N}
""")
def hot_words_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Top N over all documents
    return words.hot_words(table(spark, sf_dir, "documents", ["source", "text"]), "text", [], TOP_N)


_Q_DOCS = _sql_docs_period(SQL_QUARTER_TIME, _SQL_QUARTER)
_E_DOCS = _sql_docs_period(SQL_ERA_TIME, _SQL_ERA)


@register("hot_words_by_quarter",
          _sql_top("source, period", _sql_counts("source, period", _sql_tokens("source, period", _Q_DOCS))))
def hot_words_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.hot_words(_docs_quarter(spark, sf_dir), "text", ["source", "period"], TOP_N)


@register("hot_words_by_era",
          _sql_top("source, period", _sql_counts("source, period", _sql_tokens("source, period", _E_DOCS))))
def hot_words_by_era(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.hot_words(_docs_era(spark, sf_dir), "text", ["source", "period"], TOP_N)


_SQL_LEVELS = (
    "SELECT source, CASE WHEN grouping(period) = 1 THEN 'overall' ELSE period END AS period, word, "
    f"CAST(count(*) AS BIGINT) AS freq FROM ({_sql_tokens('source, period', _Q_DOCS)}) k "
    "GROUP BY GROUPING SETS ((source, word), (source, period, word))"
)


@register("hot_words_grouping_sets", _sql_top("source, period", _SQL_LEVELS))
def hot_words_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.hot_words_levels(_docs_quarter(spark, sf_dir), "text", "source", "period", TOP_N)


_SQL_ANTI = (
    "SELECT word, CAST(count(*) AS BIGINT) AS freq FROM ("
    f"SELECT unnest(string_split_regex({_SQL_CLEAN}, '\\s+')) AS word FROM documents) t "
    f"WHERE word <> '' AND word NOT IN (SELECT * FROM (VALUES {', '.join('(' + sql_list([w])[1:-1] + ')' for w in default_stop_words())}) s(w)) "
    "GROUP BY word"
)


@register("stopword_anti_join", _SQL_ANTI)
def stopword_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["source", "text"])
    tokens = words.word_tokens(docs, "text", [], stop_words=[])
    # The stop list is a fixed ~250-row table: broadcasting it is bounded.
    kept = tokens.join(F.broadcast(stop_words_frame(spark)), "word", "left_anti")
    return words.word_counts(kept)


def _pivot_cols(quarters):
    return [trend.period_column_name(q) for q in quarters]


def _sql_pivot(quarters, top_filter: str, top_src: str) -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN period = '{q}' THEN freq ELSE 0 END) AS BIGINT) AS {trend.period_column_name(q)}"
        for q in quarters
    )
    counts = _sql_counts("period", _sql_tokens("period", _Q_DOCS))
    top = (
        f"SELECT word FROM (SELECT word, row_number() OVER (ORDER BY sum(freq) DESC, word) AS rk "
        f"FROM ({counts}) c WHERE {top_filter} GROUP BY word) t WHERE rk <= {TOP_N}"
    )
    return f"SELECT word, {sums} FROM ({counts}) c WHERE word IN ({top}) AND {top_src} GROUP BY word"


@register("word_period_pivot", _sql_pivot(QUARTERS_2023 + QUARTERS_2024, "TRUE", "TRUE"))
def word_period_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = words.word_counts(words.word_tokens(_docs_quarter(spark, sf_dir), "text", ["period"]), ["period"])
    return trend.word_period_matrix(counts, QUARTERS_2023 + QUARTERS_2024, TOP_N)


def _sql_half(quarters) -> str:
    in_half = f"period IN {sql_list(quarters)}"
    return _sql_pivot(quarters, in_half, in_half)


_SQL_TREND = (
    f"SELECT coalesce(a.word, b.word) AS word, "
    + ", ".join(f"coalesce(a.{c}, 0) AS {c}" for c in _pivot_cols(QUARTERS_2023))
    + ", "
    + ", ".join(f"coalesce(b.{c}, 0) AS {c}" for c in _pivot_cols(QUARTERS_2024))
    + f" FROM ({_sql_half(QUARTERS_2023)}) a FULL OUTER JOIN ({_sql_half(QUARTERS_2024)}) b ON a.word = b.word"
)


@register("trend_full_outer", _SQL_TREND)
def trend_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = words.word_counts(words.word_tokens(_docs_quarter(spark, sf_dir), "text", ["period"]), ["period"])
    return trend.split_trend(counts, [QUARTERS_2023, QUARTERS_2024], TOP_N)


# --- the whole report flow: per-source period rules -------------------------
QUARTER_SOURCES = [f"src{i}" for i in range(0, 5)]
ERA_SOURCES = [f"src{i}" for i in range(5, 10)]

_SQL_RULE_DOCS = (
    f"(SELECT source, text, CASE WHEN source IN {sql_list(QUARTER_SOURCES)} THEN {_SQL_QUARTER} "
    f"WHEN source IN {sql_list(ERA_SOURCES)} THEN {_SQL_ERA} END AS period FROM ("
    f"SELECT source, text, CAST(try_strptime(substr({SQL_ERA_TIME}, 1, 10), '%Y-%m-%d') AS DATE) AS d "
    f"FROM documents) x)"
)
_SQL_RULE_LEVELS = (
    "SELECT * FROM (SELECT source, CASE WHEN grouping(period) = 1 THEN 'overall' ELSE period END AS period, word, "
    f"CAST(count(*) AS BIGINT) AS freq FROM ({_sql_tokens('source, period', _SQL_RULE_DOCS)}) k "
    "GROUP BY GROUPING SETS ((source, word), (source, period, word))) g WHERE period IS NOT NULL"
)


@register("hot_word_reports", _sql_top("source, period", _SQL_RULE_LEVELS))
def hot_word_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_with_time(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]),
                               ERA_START, ERA_DAYS)
    return words.hot_word_reports(docs, "time", "text", "source",
                                  quarter_sources=QUARTER_SOURCES, era_sources=ERA_SOURCES, n=TOP_N)
