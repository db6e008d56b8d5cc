"""Issue extraction with quality filters and the near-duplicate cascade.

Order of operations follows the extraction query it replaces:
1. decode the JSON payload and clean title/body (markup punctuation to
   blanks, trim, lower case) inside each yearly branch, then union the
   branches (the filters stay inside each branch and reach the scan);
2. quality filters on the cleaned, not yet collapsed, text (doubled blanks
   still count as tokens);
3. collapse whitespace runs;
4. one survivor per title prefix, where the prefix is taken from the title
   before the collapse;
5. one survivor per body slice, three times, on the collapsed body.
Ties on the order column are broken by the id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.functions import text as T
from threadsift.functions.predicates import max_length, min_tokens
from threadsift.operators.dedupe import first_per_key, slice_key

# --- fixed values -----------------------------------------------------------
EVENT_TYPE = "IssuesEvent"
ACTION = "opened"
MIN_BODY_TOKENS, MIN_TITLE_TOKENS = 10, 5
MAX_TITLE_CHARS, MAX_BODY_CHARS = 400, 2000
TITLE_PREFIX = ("title", 1, 22)
# Body slices as (start, length); position 0 of the source dialect is 1 here.
BODY_SLICES = (("body", 1, 40), ("body", 40, 80), ("body", 80, 120))
PATH_ACTION = "$.action"
PATH_URL = "$.issue.html_url"
PATH_TITLE = "$.issue.title"
PATH_BODY = "$.issue.body"
# --------------------------------------------------------------------------


def issues_from_events(events: DataFrame) -> DataFrame:
    """P2 + F1 + F3 + F5: opened issues -> ``id, created_at, url, title, body``."""
    payload = F.col("payload")
    opened = events.where((F.col("type") == EVENT_TYPE)
                          & (T.json_path(payload, PATH_ACTION) == ACTION))
    return opened.select(
        "id", "created_at",
        T.json_path(payload, PATH_URL).alias("url"),
        T.lower_trim(T.replace_markup_punct(T.json_path(payload, PATH_TITLE))).alias("title"),
        T.lower_trim(T.replace_markup_punct(T.json_path(payload, PATH_BODY))).alias("body"),
    )


def union_extracts(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union of yearly extracts."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_cascade(issues: DataFrame, order_col: str = "url", id_col: str = "id",
                    short_text: str = "collapse") -> DataFrame:
    """Steps 2-5 on cleaned issues; output ``id, created_at, url, title, body``."""
    kept = issues.where(
        min_tokens("body", MIN_BODY_TOKENS) & min_tokens("title", MIN_TITLE_TOKENS)
        & max_length("title", MAX_TITLE_CHARS) & max_length("body", MAX_BODY_CHARS))
    collapsed = kept.select(
        id_col, "created_at", "url",
        T.collapse_whitespace("title").alias("title"), T.collapse_whitespace("body").alias("body"),
        F.col("title").alias("_title_raw"),
    )
    order = [F.col(order_col), F.col(id_col)]
    _, start, length = TITLE_PREFIX
    keys = [slice_key("_title_raw", start, length, id_col, short_text)]
    keys += [slice_key(col, start, length, id_col, short_text) for col, start, length in BODY_SLICES]
    row = F.xxhash64(*collapsed.columns).alias("_row")
    # the cascade carries slices only; the texts of its survivors are fetched at the end
    step = collapsed.select(id_col, order_col, row, *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    for i in range(len(keys)):
        step = first_per_key(step, [f"_k{i}"], order)
    kept = collapsed.withColumn("_row", row).join(step.select(id_col, "_row"), [id_col, "_row"])
    # copies of a whole row count once (the join has them side by side)
    return kept.dropDuplicates([id_col, "_row"]).drop("_title_raw", "_row")
