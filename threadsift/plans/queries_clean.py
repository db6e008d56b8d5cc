"""Cleaner queries: markup, tags, entities, news records, URL slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.functions import text as T
from threadsift.operators import clean
from threadsift.plans.registry import register, sql_qa_text
from threadsift.plans.tables import table


_SQL_UNESCAPE = (
    "replace(replace(replace(replace(html, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"
)
_SQL_X1 = sql_qa_text(_SQL_UNESCAPE)


@register("markup_clean", f"SELECT page_id, {_SQL_X1} AS text FROM pages")
def markup_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", ["page_id", "html"])
    return pages.select("page_id", clean.clean_qa_text("html").alias("text"))


def _tags_col() -> Column:
    raw = F.concat(F.lit("<"), F.col("source"), F.lit("><"), F.col("lang"), F.lit("-"),
                   F.upper(F.col("lang")), F.lit(">"))
    return F.when(F.col("doc_id") % 9 == 0, F.lit("-")).otherwise(raw)


@register("tags_normalise", """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN ''
  ELSE trim(regexp_replace(replace(replace('<' || source || '><' || lang || '-' || upper(lang) || '>', '<', ''), '>', ' '), '\\s+', ' ', 'g'))
  END AS tags
FROM documents
""")
def tags_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "source", "lang"])
    return docs.select("doc_id", T.clean_tags(_tags_col()).alias("tags"))


_SQL_ENTITY_INPUT = "role || ' &#8217; ' || text || ' &#x27; &quot;&#39;'"


@register("entity_strip", f"""
SELECT conv_id, turn, nullif(trim(regexp_replace(regexp_replace({_SQL_ENTITY_INPUT}, '&#[0-9]+;', '', 'g'), '\\s+', ' ', 'g')), '') AS text
FROM conversations
""")
def entity_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    raw = F.concat(F.col("role"), F.lit(" &#8217; "), F.col("text"), F.lit(" &#x27; &quot;&#39;"))
    return conv.select("conv_id", "turn", T.strip_numeric_entities(raw).alias("text"))


def _news_rows(conv: DataFrame) -> DataFrame:
    """conversations -> 7-column news rows (all text), one per turn."""
    time = F.when(F.col("turn") == 2, F.lit("junk")).otherwise(
        F.format_string("2024-%02d-%02d %02d:%02d:%02d", (F.col("conv_id") % 12) + 1,
                        (F.col("conv_id") % 28) + 1, F.col("turn"), F.col("conv_id") % 60, F.col("turn")))
    text = F.when(F.col("turn") == 3, F.lit(" &#39; ")).otherwise(F.concat(F.col("text"), F.lit(" &#39;")))
    return conv.select(
        F.col("conv_id").cast("string").alias("id"), F.col("role").alias("title"), text.alias("text"),
        F.col("role").alias("by"), F.col("turn").cast("string").alias("score"), time.alias("time"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.upper("role")).alias("type"),
    )


@register("news_clean", """
WITH rows AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, role AS title,
         CASE WHEN turn = 3 THEN ' &#39; ' ELSE text || ' &#39;' END AS text, role AS "by",
         CAST(turn AS VARCHAR) AS score,
         CASE WHEN turn = 2 THEN 'junk' ELSE printf('2024-%02d-%02d %02d:%02d:%02d', conv_id % 12 + 1, conv_id % 28 + 1, turn, conv_id % 60, turn) END AS time,
         CASE WHEN role = 'system' THEN '' ELSE upper(role) END AS type
  FROM conversations
), cleaned AS (
  SELECT id, title, nullif(trim(regexp_replace(regexp_replace(text, '&#[0-9]+;', '', 'g'), '\\s+', ' ', 'g')), '') AS text,
         "by", score, strftime(try_strptime(time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS time,
         lower(nullif(type, '')) AS type
  FROM rows
)
SELECT id, title, text, "by", score, time, type FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY CAST(score AS INTEGER)) AS rn
  FROM cleaned WHERE id <> '' AND text IS NOT NULL) t
WHERE rn = 1
""")
def news_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _news_rows(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return clean.clean_news(rows, order=[F.col("score").cast("int")])


def _question_rows(pages: DataFrame) -> DataFrame:
    """pages -> question rows with a slug ``url`` and ``creationTime`` in microseconds."""
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    slug = F.concat(
        F.when(F.col("page_id") % 3 == 0, F.lit(" /unanswered/")).otherwise(F.lit("/")),
        F.replace(host, F.lit("."), F.lit("-")), F.lit("\t"), F.upper(F.split_part("url", F.lit("/"), F.lit(4))),
        F.when(F.col("page_id") % 5 == 0, F.lit("//")).otherwise(F.lit("")),
    )
    url = F.when(F.col("page_id") % 7 == 0, F.lit("")).otherwise(slug)
    micros = (F.col("page_id") - 5) * F.lit(3_600_000_000).cast("bigint") + F.lit(1_700_000_000_000_000)
    micros = F.when(F.col("page_id") < 5, -F.col("page_id") - 1).otherwise(micros)
    return pages.select("page_id", url.alias("url"), micros.alias("creationTime"))


_SQL_QROWS = """
  SELECT page_id,
    CASE WHEN page_id % 7 = 0 THEN '' ELSE
      (CASE WHEN page_id % 3 = 0 THEN ' /unanswered/' ELSE '/' END)
      || replace(regexp_extract(url, '^https?://([^/]+)', 1), '.', '-') || chr(9) || upper(split_part(url, '/', 4))
      || (CASE WHEN page_id % 5 = 0 THEN '//' ELSE '' END) END AS url,
    CASE WHEN page_id < 5 THEN -page_id - 1 ELSE (page_id - 5) * 3600000000 + 1700000000000000 END AS creationTime
  FROM pages
"""
_SQL_STRIP = "regexp_replace(regexp_replace(trim(url), '^/+', ''), '/+$', '')"


@register("slug_normalise", f"""
SELECT page_id, strftime(make_timestamp(creationTime), '%Y-%m-%d %H:%M:%S') AS time,
       lower(regexp_replace(regexp_replace({_SQL_STRIP}, '^unanswered/', ''), '-|\\t', ' ', 'g')) AS text
FROM ({_SQL_QROWS}) q WHERE url IS NOT NULL AND url <> '' AND creationTime >= 0
""")
def slug_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _question_rows(table(spark, sf_dir, "pages"))
    return clean.clean_question(rows, keep=["page_id"])


@register("url_first_segment", f"""
SELECT page_id, split_part({_SQL_STRIP}, '/', 1) AS segment FROM ({_SQL_QROWS}) q
""")
def url_first_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _question_rows(table(spark, sf_dir, "pages"))
    return rows.select("page_id", T.first_path_segment("url").alias("segment"))
