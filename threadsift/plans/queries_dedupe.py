"""De-duplication, extraction and issue-cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators import clean, dedupe, extract
from threadsift.plans.adapters import SQL_BODY, SQL_QUARTER_TIME, SQL_TITLE, documents_as_issues
from threadsift.plans.registry import register
from threadsift.plans.tables import table

_SQL_ISSUES = (
    f"(SELECT doc_id AS id, {SQL_QUARTER_TIME} AS created_at, "
    "'https://example.invalid/' || source || '/issues/' || CAST(doc_id AS VARCHAR) AS url, "
    f"{SQL_TITLE} AS title, {SQL_BODY} AS body FROM documents)"
)


def _sql_first(inner: str, key: str, cols: str = "id, created_at, url, title, body") -> str:
    return (f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY url, id) AS rn "
            f"FROM {inner} s) t WHERE rn = 1)")


def _issues(spark, sf_dir) -> DataFrame:
    return documents_as_issues(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))


@register("dedupe_prefix", f"SELECT id, title FROM {_sql_first(_SQL_ISSUES, 'substr(title, 1, 22)')} d")
def dedupe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = _issues(spark, sf_dir)
    out = dedupe.prefix_dedupe(issues, "title", 1, 22, [F.col("url"), F.col("id")])
    return out.select("id", "title")


def _sql_cascade(src: str) -> str:
    s = src
    for start, length in ((1, 40), (40, 80), (80, 120)):
        s = _sql_first(s, f"substr(body, {start}, {length})")
    return s


@register("dedupe_cascade", f"SELECT id FROM {_sql_cascade(_SQL_ISSUES)} d")
def dedupe_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = _issues(spark, sf_dir)
    out = dedupe.cascade_dedupe(issues, extract.BODY_SLICES, [F.col("url"), F.col("id")])
    return out.select("id")


_SQL_MARKUP = "'\\n|\\(|\\)|\\[|\\]|#|\\*|`|\"'"


def _sql_clean(expr: str) -> str:
    return f"lower(regexp_replace(regexp_replace({expr}, {_SQL_MARKUP}, ' ', 'g'), '^\\s+|\\s+$', '', 'g'))"


_SQL_X14_CLEAN = (
    f"(SELECT id, created_at, url, {_sql_clean('title')} AS title, {_sql_clean('body')} AS body "
    f"FROM {_SQL_ISSUES} i)"
)
_SQL_X14_FILTERED = (
    "(SELECT id, created_at, url, regexp_replace(title, '\\s{2,}', ' ', 'g') AS title, "
    "regexp_replace(body, '\\s{2,}', ' ', 'g') AS body, title AS title_raw "
    f"FROM {_SQL_X14_CLEAN} c WHERE len(string_split(body, ' ')) >= 10 AND len(string_split(title, ' ')) >= 5 "
    "AND length(title) <= 400 AND length(body) <= 2000)"
)
_SQL_X14 = (
    "SELECT id, created_at, url, title, body FROM "
    + _sql_cascade(_sql_first(_SQL_X14_FILTERED, "substr(title_raw, 1, 22)"))
    + " x"
)


@register("issue_extract_pipeline", _SQL_X14)
def issue_extract_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # raw events with a JSON payload, in two branches (2023 and 2024) that are united after decoding;
    # every document also has an event of another action, and one of another type
    issues = _issues(spark, sf_dir)
    issue = F.struct(F.col("url").alias("html_url"), "title", "body")

    def events(kind: str, action: str) -> DataFrame:
        return issues.select("id", "created_at", F.lit(kind).alias("type"),
                             F.to_json(F.struct(F.lit(action).alias("action"), issue.alias("issue"))).alias("payload"))

    raw = events(extract.EVENT_TYPE, extract.ACTION).unionByName(events(extract.EVENT_TYPE, "closed")).unionByName(
        events("PushEvent", extract.ACTION))
    years = [extract.issues_from_events(raw.where(F.col("created_at").startswith(year))) for year in ("2023-", "2024-")]
    return extract.quality_cascade(extract.union_extracts(years), "url", "id")


@register("distinct_rows", "SELECT DISTINCT lang, text FROM documents")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.distinct_rows(table(spark, sf_dir, "documents", ["lang", "text"]), ["lang", "text"])


@register("first_per_key", """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) t
WHERE rn = 1
""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    return dedupe.first_per_key(conv, ["conv_id"], [F.col("turn")])


@register("letters_truncate", f"""
SELECT doc_id, substr(regexp_replace({SQL_TITLE} || ' ' || {SQL_BODY}, '[^\\p{{L}}]', ' ', 'g'), 1, 400) AS text
FROM documents
""")
def letters_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = _issues(spark, sf_dir)
    return issues.select(F.col("id").alias("doc_id"), clean.clean_issue_text("title", "body").alias("text"))


@register("issue_clean", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {SQL_QUARTER_TIME} AS time,
       substr(regexp_replace({SQL_TITLE} || ' ' || {SQL_BODY}, '[^\\p{{L}}]', ' ', 'g'), 1, 400) AS text,
       'GH Archive' AS source
FROM documents
""")
def issue_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = _issues(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    return clean.clean_issues(issues)
