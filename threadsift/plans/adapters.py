"""Shape the driver tables into the records the operators expect.

``documents`` has no time column; queries that need periods derive a
deterministic posting date from the id (two years from 2023-01-01 for
quarters, eighteen years from 2007-01-01 for eras) and render it as text,
so the period functions parse text the way the source files hold it.
Issue-like records take the first line of a document as title and the rest
as body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed parameters of the derived posting dates.
QUARTER_START, QUARTER_DAYS = "2023-01-01", 730
ERA_START, ERA_DAYS = "2007-01-01", 6570


def derived_date_text(id_col: str, start: str, days: int) -> Column:
    d = F.date_add(F.lit(start).cast("date"), (F.col(id_col) % days).cast("int"))
    # a date cast to text is yyyy-MM-dd and, unlike date_format, zone-free
    return F.concat(d.cast("string"), F.lit(" 00:00:00"))


def documents_with_time(docs: DataFrame, start: str = QUARTER_START,
                        days: int = QUARTER_DAYS) -> DataFrame:
    """``doc_id, source, text, time`` with ``time`` as ``yyyy-MM-dd HH:mm:ss`` text."""
    return docs.select("doc_id", "source", "text",
                       derived_date_text("doc_id", start, days).alias("time"))


def title_col(text: str = "text") -> Column:
    """First line of the text."""
    return F.substring_index(F.col(text), "\n", 1)


def body_col(text: str = "text") -> Column:
    """Everything after the first line (empty when there is one line)."""
    return F.substring(F.col(text), F.length(title_col(text)) + 2, 1 << 30)


def documents_as_issues(docs: DataFrame) -> DataFrame:
    """``id, created_at, url, title, body`` issue records built from documents."""
    return docs.select(
        F.col("doc_id").alias("id"),
        derived_date_text("doc_id", QUARTER_START, QUARTER_DAYS).alias("created_at"),
        F.format_string("https://example.invalid/%s/issues/%d", F.col("source"), F.col("doc_id")).alias("url"),
        title_col().alias("title"),
        body_col().alias("body"),
    )


# SQL snippets for the oracle side (DuckDB).
SQL_QUARTER_TIME = (
    "strftime(DATE '2023-01-01' + CAST(doc_id % 730 AS INTEGER), '%Y-%m-%d') || ' 00:00:00'"
)
SQL_ERA_TIME = (
    "strftime(DATE '2007-01-01' + CAST(doc_id % 6570 AS INTEGER), '%Y-%m-%d') || ' 00:00:00'"
)
SQL_TITLE = "split_part(text, chr(10), 1)"
SQL_BODY = "substr(text, length(split_part(text, chr(10), 1)) + 2)"
