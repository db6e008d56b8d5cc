"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col
from threadsift.functions.text import token_count

# Text that counts as "missing" after trimming, and the
# case-insensitive word that counts as missing without trimming.
MISSING_MARKERS = ("", "-")
MISSING_WORD = "null"


def is_missing(c) -> Column:
    """Null, blank, ``-`` or ``null`` in any case (the last one untrimmed).

    Written so that long texts cost almost nothing: the anchored pattern
    (whitespace, an optional dash, whitespace) fails at the first other
    character, and only 4-character values are lower-cased.
    """
    col = as_col(c)
    return (
        col.isNull()
        | col.rlike(r"(?U)^\s*-?\s*$")
        | ((F.length(col) == len(MISSING_WORD)) & (F.lower(col) == MISSING_WORD))
    )


def is_blank(c) -> Column:
    """Null, empty or whitespace only."""
    col = as_col(c)
    return col.isNull() | col.rlike(r"(?U)^\s*$")


def is_filled(c) -> Column:
    """A2: non-null and non-empty (whitespace counts as filled)."""
    col = as_col(c)
    return col.isNotNull() & (col != "")


def min_tokens(c, n: int, sep: str = " ") -> Column:
    """P4."""
    return token_count(c, sep) >= n


def max_length(c, n: int) -> Column:
    """P5."""
    return F.length(as_col(c)) <= n
