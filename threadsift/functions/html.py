"""HTML entity decoding.

Most text only holds a handful of common named entities, which chained
``replace`` calls decode inside codegen. Only rows holding any other entity
(numeric, rare named, or a legacy form without ``;``) need Python's full
``html.unescape``; for every other row the Arrow UDF receives a null, so the
Python worker does real work only where the JVM path cannot be exact.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from threadsift.functions.cols import as_col

# --- fixed values -----------------------------------------------------------
# Named entities decoded on the JVM side, with their characters. ``&amp;``
# must be decoded last so that ``&amp;lt;`` becomes ``&lt;`` (one pass).
COMMON_ENTITIES = (
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", " "),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&amp;", "&"),
)
# --------------------------------------------------------------------------

_COMMON_NAMES = "|".join(e[1:-1] for e, _ in COMMON_ENTITIES)
# Any '&' that starts something other than a common entity with ';'.
_NEEDS_FULL = rf"&(?!(?:{_COMMON_NAMES});)[#A-Za-z]"


@F.pandas_udf(StringType())
def _unescape_full(s: pd.Series) -> pd.Series:
    return s.map(lambda v: html.unescape(v) if isinstance(v, str) else None)


def unescape_common(c) -> Column:
    """Decode the common named entities only (JVM side)."""
    col = as_col(c)
    for entity, char in COMMON_ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def unescape_html(c, full: bool = True) -> Column:
    """same result as Python's ``html.unescape``.

    With ``full=False`` only the common entities are decoded and no Python
    runs at all.
    """
    col = as_col(c)
    common = unescape_common(col)
    if not full:
        return common
    rare = _unescape_full(F.when(col.rlike(_NEEDS_FULL), col))
    return F.coalesce(rare, common)
