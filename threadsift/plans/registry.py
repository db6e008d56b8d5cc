"""Registry of named queries over the driver tables and their SQL oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame``. The oracle is an
independent SQL formulation that DuckDB runs on the same parquet files; both
must produce the same columns (names and values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadsift.functions.text import QA_STEPS

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle (optional)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def sql_list(values) -> str:
    """A SQL literal list ``('a', 'b')`` with quotes escaped."""
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def sql_qa_text(expr: str) -> str:
    """The Q&A cleaner's steps in DuckDB SQL (its patterns without Java's flags)."""
    for pattern, repl in QA_STEPS:
        pattern = pattern.removeprefix("(?U)").removeprefix("(?d)")
        expr = f"regexp_replace({expr}, '{pattern}', '{repl}', 'g')"
    return f"lower(trim({expr}))"


def load_all() -> None:
    """Import every module that registers queries."""
    from threadsift.plans import (  # noqa: F401
        queries_clean,
        queries_dedupe,
        queries_ml,
        queries_profile,
        queries_qa,
        queries_sample,
        queries_scan,
        queries_words,
    )
