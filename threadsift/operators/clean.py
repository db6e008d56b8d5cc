"""Source cleaners (X1-X4) as DataFrame transformations.

Each cleaner is a ``select`` of built-in expressions plus the filters the
source job applied, so a cleaner is a narrow, map-only stage. The news
cleaner also removes duplicate ids; that is a hash-partitioned aggregate on
the id, never one reducer holding every id.

Given ``DropCounts``, a cleaner also counts the rows it drops, by reason, in the very pass that uses its
result (``DataFrame.observe``): no second scan, and dropped rows are accounted for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from threadsift.functions import text as T
from threadsift.functions.cols import as_col
from threadsift.functions.html import unescape_html
from threadsift.functions.predicates import is_missing
from threadsift.operators.dedupe import first_per_key
from threadsift.operators.sorting import range_sorted

# Fixed value: post types kept by the Q&A cleaner (questions, answers).
QA_POST_TYPES = ("1", "2")
# Fixed value: constant source label of cleaned issues.
ISSUE_SOURCE = "GH Archive"


class DropCounts:
    """Row counts of one cleaner run; ``values`` is filled by the first action on the cleaner's result.

    ``rows`` (input), ``kept``, and one entry per reason: a row counts for the first reason that holds for it.
    ``kept`` is counted before later steps merge rows; rows removed as ``duplicate`` are the difference to what came out.
    Counts are exact as long as no task is run twice after its result was used (a lost executor may add to them).
    """

    def __init__(self) -> None:
        self._seen, self._out = Observation(), None

    @property
    def values(self) -> dict[str, int]:
        found = dict(self._seen.get)
        if self._out is not None:
            out = self._out.get["rows"]
            found |= {"duplicate": found["kept"] - out, "kept": out}
        return found

    def _count(self, df: DataFrame, reason: str, names: Sequence[str], more: Mapping[str, Column]) -> DataFrame:
        why = F.col(reason)
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), F.count_if(why.isNull()).alias("kept"),
                          *[F.count_if(F.coalesce(why == n, F.lit(False))).alias(n) for n in names],
                          *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in more.items()])

    def _count_out(self, df: DataFrame) -> DataFrame:
        self._out = Observation()
        return df.observe(self._out, F.count(F.lit(1)).alias("rows"))


def _first_reason(reasons: Mapping[str, Column]) -> Column:
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in reasons.items()])


def _without(df: DataFrame, reasons: Mapping[str, Column], counts: DropCounts | None, more: Mapping[str, Column] = {}) -> DataFrame:
    """``df`` without the rows for which a reason holds, counted if asked for."""
    if counts is None:
        holds = [F.coalesce(c, F.lit(False)) for c in reasons.values()]
        return df.where(~reduce(or_, holds))
    tagged = df.withColumn("_reason", _first_reason(reasons))
    return counts._count(tagged, "_reason", list(reasons), more).where(F.col("_reason").isNull()).drop("_reason")


def clean_qa_text(c, full_unescape: bool = True) -> Column:
    """Unescape, strip tags, drop code and URLs, keep word punctuation, normalise.

    Each step is applied once to the output of the previous one (no guarded
    branches: those reference their input several times and multiply the
    expression tree, which defeats whole-stage code generation).
    """
    col = unescape_html(as_col(c), full=full_unescape)
    col = T.strip_tags(col)
    col = T.drop_fenced_code(col)
    col = T.drop_inline_code(col)
    col = T.drop_urls(col)
    col = T.keep_word_punct(col)
    return T.normalise_whitespace_lower(col)


def clean_qa_posts(df: DataFrame, full_unescape: bool = True, keep_empty: bool = False,
                   counts: DropCounts | None = None) -> DataFrame:
    """X1 row job: 13-column posts -> ``Id, PostTypeId, text, tags, CreationDate, Score``.

    Keeps questions and answers with id, type and date present and some text
    left after cleaning (``keep_empty`` keeps posts without any, for the
    counters). Title and body are cleaned separately and joined with a blank;
    the join is trimmed (a missing part leaves no blank). ``counts`` gets the reasons ``other_type``,
    ``missing_id``, ``missing_date``, ``empty_text``, and of the posts with id, type and date the
    ``questions``, ``answers`` and ``posts_with_tags``.
    """
    parts = [F.when(~is_missing(c), clean_qa_text(c, full_unescape)) for c in ("Title", "Body")]
    text = F.trim(F.concat_ws(" ", *parts))
    unusable = {"other_type": ~F.coalesce(F.col("PostTypeId").isin(*QA_POST_TYPES), F.lit(False)),
                "missing_id": is_missing("Id"), "missing_date": is_missing("CreationDate")}
    fields = [T.clean_tags("Tags").alias("tags"), "CreationDate",
              F.coalesce(F.nullif(F.col("Score"), F.lit("")), F.lit("0")).alias("Score")]
    empty = {} if keep_empty else {"empty_text": F.col("text") == ""}
    if counts is None:
        out = _without(df, unusable, None).select("Id", "PostTypeId", text.alias("text"), *fields)
        return _without(out, empty, None) if empty else out
    # unusable posts stay until they are counted, but their text is not cleaned
    early = df.withColumn("_early", _first_reason(unusable))
    out = early.select("Id", "PostTypeId", F.when(F.col("_early").isNull(), text).alias("text"), *fields, "_early")
    usable = F.col("_early").isNull()
    more = {"questions": usable & (F.col("PostTypeId") == QA_POST_TYPES[0]), "answers": usable & (F.col("PostTypeId") == QA_POST_TYPES[1]),
            "posts_with_tags": usable & (F.col("tags") != "")}
    reasons = {name: F.col("_early") == name for name in unusable} | empty
    return _without(out, reasons, counts, more).drop("_early")


def clean_news(df: DataFrame, order: list[Column] | None = None, counts: DropCounts | None = None) -> DataFrame:
    """7-column news rows -> cleaned records, one per id.

    Text loses numeric entities and extra whitespace (empty -> dropped), time
    becomes ISO text (null if invalid), type is lower-cased. Of several rows
    with the same id the first by ``order`` is kept (default: a 64-bit hash
    of the row, a deterministic choice that is cheap to sort on). ``counts`` gets the reasons ``missing_id``,
    ``empty_text`` and ``duplicate``.
    """
    cleaned = df.select(
        "id", "title", T.strip_numeric_entities("text").alias("text"), "by", "score",
        T.to_iso_datetime("time").alias("time"), T.lower_or_null("type").alias("type"))
    cleaned = _without(cleaned, {"missing_id": F.coalesce(F.col("id"), F.lit("")) == "", "empty_text": F.col("text").isNull()}, counts)
    order = order or [F.xxhash64("title", "text", "by", "score", "time", "type")]
    out = first_per_key(cleaned, ["id"], order)
    return out if counts is None else counts._count_out(out)


def clean_question(df: DataFrame, keep=(), counts: DropCounts | None = None) -> DataFrame:
    """Question rows (``url``, ``creationTime`` in microseconds) -> ``time, text``.

    Rows without a url or time, with an empty url or a negative time are
    left out; ``keep`` names extra columns to carry along. ``counts`` gets the reasons ``missing_url``,
    ``missing_time`` and ``negative_time``.
    """
    kept = _without(df, {"missing_url": F.col("url").isNull() | (F.col("url") == ""), "missing_time": F.col("creationTime").isNull(),
                         "negative_time": F.col("creationTime") < 0}, counts)
    return kept.select(*keep, T.micros_to_text("creationTime").alias("time"), T.slug_to_text("url").alias("text"))


def clean_issue_text(title, body, limit: int = 400) -> Column:
    """X4 text: title + blank + body, non-letters to blanks, first ``limit`` characters."""
    return T.truncate(T.letters_only(F.concat_ws(" ", as_col(title), as_col(body))), limit)


def clean_issues(df: DataFrame, num_ranges: int | None = None, limit: int = 400, counts: DropCounts | None = None) -> DataFrame:
    """``id, created_at, title, body`` -> ``id, time, text, source`` sorted by numeric id.

    Output is range-partitioned on the id into sorted runs (``num_ranges`` of
    them, or the session's number of shuffle partitions).
    Ids that are not numbers belong in the quarantine (see sources.readers); here they are left out, and
    ``counts`` gets them as ``bad_id``.
    The text is cleaned after the range exchange (on the reduce side). Copies of
    one row, or rows of one very frequent id, spread over adjacent ranges (``sorting.range_sorted``); ids stay in order.
    """
    kept = _without(df.select("id", "created_at", "title", "body"), {"bad_id": T.parse_long("id").isNull()}, counts)
    ranged = range_sorted(kept, T.parse_long("id"), num_ranges)
    return ranged.select(
        F.col("id"), F.col("created_at").alias("time"),
        clean_issue_text("title", "body", limit).alias("text"), F.lit(ISSUE_SOURCE).alias("source"),
    )
