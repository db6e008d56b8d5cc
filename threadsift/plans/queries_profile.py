"""Profile queries: completeness, missing values, distributions, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.functions.predicates import is_missing
from threadsift.functions.text import trim_whitespace
from threadsift.operators import clean, profile
from threadsift.plans.adapters import (
    SQL_BODY,
    SQL_QUARTER_TIME,
    SQL_TITLE,
    body_col,
    derived_date_text,
    documents_as_issues,
    title_col,
)
from threadsift.plans.queries_clean import _SQL_QROWS, _news_rows, _question_rows
from threadsift.plans.queries_scan import _DT_SQL, _datetime_text
from threadsift.plans.registry import register, sql_qa_text
from threadsift.plans.tables import table
from threadsift.schemas import NEWS_FIELDS

# --- events shaped as 7-column news rows, with gaps injected by id digit ----


def _news_view(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(e % 10 == 0, F.concat(e.cast("string"), F.lit("a"))).otherwise(e.cast("string")).alias("id"),
        F.when(e % 7 == 0, F.lit("")).otherwise(F.col("event_type")).alias("title"),
        F.when(e % 11 == 0, F.lit("   ")).when(e % 13 == 0, F.lit(None)).otherwise(F.col("props")).alias("text"),
        F.col("user_id").cast("string").alias("by"),
        F.when(e % 17 == 0, F.lit("")).otherwise(F.col("value").cast("string")).alias("score"),
        _datetime_text().alias("time"),
        F.when(e % 19 == 0, F.lit("")).otherwise(F.col("event_type")).alias("type"),
    )


_SQL_NEWS = f"""(SELECT
  CASE WHEN event_id % 10 = 0 THEN CAST(event_id AS VARCHAR) || 'a' ELSE CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS title,
  CASE WHEN event_id % 11 = 0 THEN '   ' WHEN event_id % 13 = 0 THEN NULL ELSE props END AS text,
  CAST(user_id AS VARCHAR) AS "by",
  CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS score,
  {_DT_SQL} AS time,
  CASE WHEN event_id % 19 = 0 THEN '' ELSE event_type END AS type
FROM events)"""


def _sql_unpivot(columns, expr_of, name: str, value: str, src: str, where: str = "") -> str:
    parts = [f"SELECT '{c}' AS {name}, {expr_of(c)} AS {value} FROM {src} s" for c in columns]
    body = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) u {where}"


def _q(c: str) -> str:
    return f'"{c}"'


@register("completeness", _sql_unpivot(
    NEWS_FIELDS,
    lambda c: f"CAST(avg(CASE WHEN {_q(c)} IS NOT NULL AND {_q(c)} <> '' THEN 1.0 ELSE 0.0 END) AS DOUBLE)",
    "column", "ratio", _SQL_NEWS))
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.completeness(_news_view(spark, sf_dir), list(NEWS_FIELDS))


@register("missing_counts", _sql_unpivot(
    NEWS_FIELDS,
    lambda c: f"CAST(count(*) FILTER (WHERE {_q(c)} IS NULL OR regexp_matches({_q(c)}, '^\\s*$')) AS BIGINT)",
    "column", "missing", _SQL_NEWS, "WHERE missing > 0"))
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_counts(_news_view(spark, sf_dir), list(NEWS_FIELDS))


# --- customer as text columns with the missing markers of the Q&A profile ---
_CUST_COLS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
_MARKERS = ("-", "NULL", " null ", "", "  ", None)


def _customer_text(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")

    def spoil(col: Column, shift: int) -> Column:
        expr = None
        for i, m in enumerate(_MARKERS):
            cond = (k + shift) % 23 == i
            val = F.lit(m).cast("string")
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        return expr.otherwise(col.cast("string"))

    cust = table(spark, sf_dir, "customer")
    return cust.select(*[spoil(F.col(c), i * 3).alias(c) if i else F.col(c).cast("string").alias(c)
                         for i, c in enumerate(_CUST_COLS)])


def _sql_customer_text() -> str:
    cols = []
    for i, c in enumerate(_CUST_COLS):
        if i == 0:
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
            continue
        whens = " ".join(
            f"WHEN (c_custkey + {i * 3}) % 23 = {j} THEN " + ("NULL" if m is None else "'" + m + "'")
            for j, m in enumerate(_MARKERS))
        cols.append(f"CASE {whens} ELSE CAST({c} AS VARCHAR) END AS {c}")
    return "(SELECT " + ", ".join(cols) + " FROM customer)"


@register("missing_counts_dash_null", _sql_unpivot(
    _CUST_COLS,
    lambda c: f"CAST(count(*) FILTER (WHERE {c} IS NULL OR trim({c}) IN ('', '-') OR lower({c}) = 'null') AS BIGINT)",
    "column", "missing", _sql_customer_text(), "WHERE missing > 0"))
def missing_counts_dash_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_counts(_customer_text(spark, sf_dir), list(_CUST_COLS), rule=is_missing)


@register("category_distribution", f"""
SELECT 'type_id' AS metric, CASE WHEN coalesce(regexp_matches(id, '^[0-9]+$'), false) THEN 'numeric' ELSE 'non_numeric' END AS category,
       CAST(count(*) AS BIGINT) AS n FROM {_SQL_NEWS} a GROUP BY 2
UNION ALL
SELECT 'type_time', CASE WHEN regexp_matches(time, '^[0-9]{{4}}-') AND try_strptime(time, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 'datetime' ELSE 'invalid_datetime' END,
       CAST(count(*) AS BIGINT) FROM {_SQL_NEWS} b GROUP BY 2
UNION ALL
SELECT 'type_distribution', type, CAST(count(*) AS BIGINT) FROM {_SQL_NEWS} c GROUP BY 2
""")
def category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_distribution(_news_view(spark, sf_dir), "id", "time", "type")


@register("text_length_profile", """
SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(min(length(text)) AS INTEGER) AS min_len,
       CAST(max(length(text)) AS INTEGER) AS max_len, round(avg(length(text)), 6) AS avg_len,
       round(quantile_cont(CAST(length(text) AS DOUBLE), 0.5), 9) AS p50,
       round(quantile_cont(CAST(length(text) AS DOUBLE), 0.9), 9) AS p90
FROM documents GROUP BY source
""")
def text_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = profile.length_profile(table(spark, sf_dir, "documents"), "text", ["source"], (0.5, 0.9))
    # interpolated percentiles rounded to 9 decimals in both engines
    return prof.withColumn("p50", F.round("p50", 9)).withColumn("p90", F.round("p90", 9))


# --- part.p_size as text, spoiled by key digit ------------------------------


def _size_text(spark, sf_dir) -> DataFrame:
    k, s = F.col("p_partkey") % 10, F.col("p_size").cast("string")
    txt = (F.when(k == 0, F.concat(F.lit("x"), s)).when(k == 1, F.lit("-")).when(k == 2, F.lit(""))
           .when(k == 3, F.concat(F.lit(" "), s, F.lit(" "))).when(k == 4, F.lit("NULL"))
           .when(k == 5, F.concat(s, F.lit(".0"))).when(k == 6, F.concat(s, F.lit("000000000000000000000000")))
           .otherwise(s))
    return table(spark, sf_dir, "part").select(txt.alias("p_size"))


_SQL_SIZE = """(SELECT CASE p_partkey % 10 WHEN 0 THEN 'x' || CAST(p_size AS VARCHAR) WHEN 1 THEN '-' WHEN 2 THEN ''
  WHEN 3 THEN ' ' || CAST(p_size AS VARCHAR) || ' ' WHEN 4 THEN 'NULL' WHEN 5 THEN CAST(p_size AS VARCHAR) || '.0' WHEN 6 THEN CAST(p_size AS VARCHAR) || '000000000000000000000000'
  ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part)"""
_SQL_PRESENT = "NOT (p_size IS NULL OR trim(p_size) IN ('', '-') OR lower(p_size) = 'null')"
_SQL_INT_OK = "regexp_matches(trim(p_size), '^[+-]?[0-9]+$')"


@register("invalid_type_counts", f"""
SELECT 'p_size' AS column, CAST(count(*) FILTER (WHERE {_SQL_PRESENT} AND NOT {_SQL_INT_OK}) AS BIGINT) AS invalid
FROM {_SQL_SIZE} s HAVING invalid > 0
""")
def invalid_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.invalid_type_counts(_size_text(spark, sf_dir), ["p_size"])


@register("numeric_mean", f"""
SELECT CAST(count(*) AS BIGINT) AS n_valid, round(avg(CAST(trim(p_size) AS DOUBLE)), 2) AS avg_value
FROM {_SQL_SIZE} s WHERE {_SQL_PRESENT} AND {_SQL_INT_OK} HAVING count(*) > 0
""")
def numeric_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(_size_text(spark, sf_dir), "p_size")


@register("numeric_histogram", f"""
SELECT CAST(trim(p_size) AS DECIMAL(38, 0)) AS value, CAST(count(*) AS BIGINT) AS n
FROM {_SQL_SIZE} s WHERE {_SQL_PRESENT} AND {_SQL_INT_OK} GROUP BY 1
""")
def numeric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_histogram(_size_text(spark, sf_dir), "p_size")


# --- documents + labels as 13-column Q&A posts -----------------------------


MARKED = " \u0939\u093f\u0928\u094d\u0926\u0940 x\u00b2 \u00bd \u2167"


def _qa_posts(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "text"])
    labels = table(spark, sf_dir, "labels")
    # labels covers part of the documents; its size grows with the data, so
    # the join is left to the planner (AQE broadcasts it only if it is small).
    joined = docs.join(labels, "doc_id", "left")
    title, body = title_col(), body_col()
    ptype = F.when(F.col("doc_id") % 20 == 0, "3").when(F.col("doc_id") % 2 == 0, "2").otherwise("1")
    emptied = F.col("doc_id") % 18 == 9  # title and body clean to nothing
    # letters with marks, and numbers that are no decimal digits
    title = F.when(emptied, F.lit("<b></b>")).when(F.col("doc_id") % 7 == 0, F.concat(title, F.lit(MARKED))).otherwise(title)
    body = F.when(emptied, F.lit("<p> </p>")).otherwise(body)
    return joined.select(
        F.col("doc_id").cast("string").alias("Id"), ptype.alias("PostTypeId"), F.lit("").alias("ParentId"),
        derived_date_text("doc_id", "2023-01-01", 730).alias("CreationDate"),
        F.when(F.col("toxic") == 1, F.lit("-")).otherwise(F.length(title).cast("string")).alias("Score"),
        F.lit("").alias("ViewCount"),
        F.when(F.col("doc_id") % 6 == 0, F.lit("-")).otherwise(title).alias("Title"),
        F.when(F.col("toxic") == 1, F.lit("")).otherwise(
            F.concat(F.lit("<"), F.col("source"), F.lit("><"), F.col("lang"), F.lit(">"))).alias("Tags"),
        body.alias("Body"),
        *[F.lit("").alias(c) for c in ("OwnerUserId", "AnswerCount", "CommentCount", "FavoriteCount")],
    )


_SQL_UNESC = "replace(replace(replace(replace({x}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"


def _sql_x1(x: str) -> str:
    return sql_qa_text(_SQL_UNESC.format(x=x))


def _sql_missing(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) IN ('', '-') OR lower({x}) = 'null')"


_SQL_POST_TITLE = (f"CASE WHEN d.doc_id % 18 = 9 THEN '<b></b>' WHEN d.doc_id % 7 = 0 THEN {SQL_TITLE} || '{MARKED}' "
                   f"ELSE {SQL_TITLE} END")

_SQL_QA = f"""(SELECT CAST(d.doc_id AS VARCHAR) AS Id,
   CASE WHEN d.doc_id % 20 = 0 THEN '3' WHEN d.doc_id % 2 = 0 THEN '2' ELSE '1' END AS PostTypeId,
   {SQL_QUARTER_TIME.replace('doc_id', 'd.doc_id')} AS CreationDate,
   CASE WHEN l.toxic = 1 THEN '-' ELSE CAST(length({_SQL_POST_TITLE}) AS VARCHAR) END AS Score,
   CASE WHEN d.doc_id % 6 = 0 THEN '-' ELSE {_SQL_POST_TITLE} END AS Title,
   CASE WHEN l.toxic = 1 THEN '' ELSE '<' || source || '><' || lang || '>' END AS Tags,
   CASE WHEN d.doc_id % 18 = 9 THEN '<p> </p>' ELSE {SQL_BODY} END AS Body,
   '' AS ParentId, '' AS ViewCount, '' AS OwnerUserId, '' AS AnswerCount, '' AS CommentCount, '' AS FavoriteCount
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_SQL_QA_CLEAN = f"""(SELECT Id, PostTypeId,
   trim(concat_ws(' ', CASE WHEN NOT {_sql_missing('Title')} THEN {_sql_x1('Title')} END,
                       CASE WHEN NOT {_sql_missing('Body')} THEN {_sql_x1('Body')} END)) AS text,
   CASE WHEN {_sql_missing('Tags')} THEN '' ELSE trim(regexp_replace(replace(replace(Tags, '<', ''), '>', ' '), '\\s+', ' ', 'g')) END AS tags,
   CreationDate, coalesce(nullif(Score, ''), '0') AS Score
 FROM {_SQL_QA} q WHERE PostTypeId IN ('1', '2') AND NOT {_sql_missing('Id')} AND NOT {_sql_missing('CreationDate')})"""


@register("cleaning_counters", f"""
SELECT metric, value FROM (
  SELECT CAST(count(*) AS BIGINT) AS total_posts,
         CAST(count(*) FILTER (WHERE PostTypeId = '1') AS BIGINT) AS questions,
         CAST(count(*) FILTER (WHERE PostTypeId = '2') AS BIGINT) AS answers,
         CAST(count(*) FILTER (WHERE trim(tags) <> '') AS BIGINT) AS posts_with_tags,
         CAST(count(*) FILTER (WHERE trim(text) = '') AS BIGINT) AS empty_text
  FROM {_SQL_QA_CLEAN} c) t
UNPIVOT (value FOR metric IN (total_posts, questions, answers, posts_with_tags, empty_text))
""")
def cleaning_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = clean.clean_qa_posts(_qa_posts(spark, sf_dir), keep_empty=True)
    return profile.counters(posts, {
        "total_posts": F.lit(1),
        "questions": F.col("PostTypeId") == "1",
        "answers": F.col("PostTypeId") == "2",
        "posts_with_tags": trim_whitespace("tags") != "",
        "empty_text": trim_whitespace("text") == "",
    })


_SQL_BAD = {"other_type": "PostTypeId NOT IN ('1', '2')", "missing_id": _sql_missing("Id"), "missing_date": _sql_missing("CreationDate")}


def _sql_drops(cleaner: str, source: str, counted: dict[str, str]) -> str:
    """One row per count: ``cleaner, metric, value``."""
    counts = ", ".join(f"CAST({expr} AS BIGINT) AS {name}" for name, expr in counted.items())
    return f"SELECT '{cleaner}' AS cleaner, metric, value FROM (SELECT {counts} FROM {source} s) t UNPIVOT (value FOR metric IN ({', '.join(counted)}))"


def _sql_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_SQL_USABLE = f"FROM {_SQL_QA_CLEAN} c"
_SQL_QA_DROPS = {
    "rows": "count(*)", "other_type": _sql_if(_SQL_BAD["other_type"]),
    "missing_id": _sql_if(f"NOT ({_SQL_BAD['other_type']}) AND {_SQL_BAD['missing_id']}"),
    "missing_date": _sql_if(f"NOT ({_SQL_BAD['other_type']}) AND NOT ({_SQL_BAD['missing_id']}) AND {_SQL_BAD['missing_date']}"),
    "kept": f"(SELECT count(*) {_SQL_USABLE} WHERE text <> '')", "empty_text": f"(SELECT count(*) {_SQL_USABLE} WHERE text = '')",
    "questions": f"(SELECT count(*) {_SQL_USABLE} WHERE PostTypeId = '1')",
    "answers": f"(SELECT count(*) {_SQL_USABLE} WHERE PostTypeId = '2')",
    "posts_with_tags": f"(SELECT count(*) {_SQL_USABLE} WHERE tags <> '')",
}
_SQL_ISSUE_IDS = "(SELECT CASE WHEN doc_id % 25 = 0 THEN 'x' ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents)"


@register("cleaning_drops", " UNION ALL ".join([
    _sql_drops("qa_posts", _SQL_QA, _SQL_QA_DROPS),
    _sql_drops("news", "(SELECT conv_id, (text || ' &#39;') AS text, turn FROM conversations)", {
        "rows": "count(*)", "missing_id": "0",
        "empty_text": _sql_if("turn = 3 OR trim(regexp_replace(regexp_replace(text, '&#[0-9]+;', '', 'g'), '\\s+', ' ', 'g')) = ''"),
        "kept": "count(DISTINCT conv_id) FILTER (WHERE turn <> 3 AND trim(regexp_replace(regexp_replace(text, '&#[0-9]+;', '', 'g'), '\\s+', ' ', 'g')) <> '')",
        "duplicate": "rows - empty_text - kept"}),
    _sql_drops("questions", f"({_SQL_QROWS})", {
        "rows": "count(*)", "missing_url": _sql_if("url IS NULL OR url = ''"), "missing_time": "0",
        "negative_time": _sql_if("url <> '' AND creationTime < 0"), "kept": _sql_if("url <> '' AND creationTime >= 0")}),
    _sql_drops("issues", _SQL_ISSUE_IDS, {"rows": "count(*)", "bad_id": _sql_if("id = 'x'"), "kept": _sql_if("id <> 'x'")}),
]))
def cleaning_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What X1 to X4 drop, by reason, counted by the action that consumes their results."""
    issues = documents_as_issues(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))
    issues = issues.withColumn("id", F.when(F.col("id") % 25 == 0, F.lit("x")).otherwise(F.col("id").cast("string")))
    runs = {
        "qa_posts": lambda c: clean.clean_qa_posts(_qa_posts(spark, sf_dir), counts=c),
        "news": lambda c: clean.clean_news(_news_rows(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])), counts=c),
        "questions": lambda c: clean.clean_question(_question_rows(table(spark, sf_dir, "pages")), counts=c),
        "issues": lambda c: clean.clean_issues(issues, counts=c),
    }
    rows = []
    for cleaner, cleaned in runs.items():
        counts = clean.DropCounts()
        cleaned(counts).write.format("noop").mode("overwrite").save()
        rows += [(cleaner, metric, value) for metric, value in counts.values.items()]
    return spark.createDataFrame(rows, "cleaner string, metric string, value bigint")


@register("qa_clean_posts", f"SELECT Id, PostTypeId, text, tags, CreationDate, Score FROM {_SQL_QA_CLEAN} c WHERE text <> ''")
def qa_clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_qa_posts(_qa_posts(spark, sf_dir))


_SQL_INT_SCORE = "regexp_matches(trim(Score), '^[+-]?[0-9]+$')"


@register("clean_score_histogram", f"""
SELECT CAST(trim(Score) AS DECIMAL(38, 0)) AS value, CAST(count(*) AS BIGINT) AS n
FROM {_SQL_QA_CLEAN} c WHERE text <> '' AND NOT {_sql_missing('Score')} AND {_SQL_INT_SCORE} GROUP BY 1
""")
def clean_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The score histogram of cleaned posts
    return profile.numeric_histogram(clean.clean_qa_posts(_qa_posts(spark, sf_dir)), "Score")


# --- composite profiles (X11, X12) -------------------------

_SQL_COMPLETENESS = _sql_unpivot(
    NEWS_FIELDS,
    lambda c: f"CAST(avg(CASE WHEN {_q(c)} IS NOT NULL AND {_q(c)} <> '' THEN 1.0 ELSE 0.0 END) AS DOUBLE)",
    "column", "ratio", _SQL_NEWS)
_SQL_MISSING = _sql_unpivot(
    NEWS_FIELDS,
    lambda c: f"CAST(count(*) FILTER (WHERE {_q(c)} IS NULL OR regexp_matches({_q(c)}, '^\\s*$')) AS BIGINT)",
    "column", "missing", _SQL_NEWS, "WHERE missing > 0")


def _news_report_sql() -> str:
    from threadsift.plans.registry import ORACLE_SQL

    length = "coalesce(length(text), 0)"
    lengths = (f"SELECT CAST(count(*) AS DOUBLE) AS n, CAST(min({length}) AS DOUBLE) AS min_len, "
               f"CAST(max({length}) AS DOUBLE) AS max_len, round(avg({length}), 6) AS avg_len, "
               f"round(quantile_cont(CAST({length} AS DOUBLE), 0.5), 9) AS p50, round(quantile_cont(CAST({length} AS DOUBLE), 0.9), 9) AS p90 "
               f"FROM {_SQL_NEWS} t")
    return (
        f"SELECT 'completeness_' || \"column\" AS metric, CAST(NULL AS VARCHAR) AS category, ratio AS value FROM ({_SQL_COMPLETENESS}) a "
        f"UNION ALL SELECT metric, category, CAST(n AS DOUBLE) FROM ({ORACLE_SQL['category_distribution']}) b "
        f"UNION ALL SELECT 'missing_' || \"column\", NULL, CAST(missing AS DOUBLE) FROM ({_SQL_MISSING}) c "
        f"UNION ALL SELECT 'text_length', category, value FROM ({lengths}) l "
        "UNPIVOT (value FOR category IN (n, min_len, max_len, avg_len, p50, p90))"
    )


@register("news_profile_report", f"SELECT metric, category, round(value, 9) AS value FROM ({_news_report_sql()}) r")
def news_profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = profile.news_profile_report(_news_view(spark, sf_dir), list(NEWS_FIELDS))
    return rep.withColumn("value", F.round("value", 9))


_QA_REPORT_COLS = ("Id", "PostTypeId", "ParentId", "CreationDate", "Score", "ViewCount", "Title", "Tags", "Body",
                   "OwnerUserId", "AnswerCount", "CommentCount", "FavoriteCount")


def _qa_report_sql() -> str:
    cols = _QA_REPORT_COLS
    missing = " UNION ALL ".join(
        f"SELECT 'MISSING' AS tag, '{c}' AS field, CAST(count(*) FILTER (WHERE {_sql_missing(c)}) AS DOUBLE) AS value FROM {_SQL_QA} q"
        for c in cols)
    ok = "regexp_matches(trim(Score), '^[+-]?[0-9]+$')"
    return (
        f"SELECT * FROM ({missing}) m WHERE value > 0 "
        f"UNION ALL SELECT * FROM (SELECT 'INVALID_TYPE' AS tag, 'Score' AS field, "
        f"CAST(count(*) FILTER (WHERE NOT {_sql_missing('Score')} AND NOT {ok}) AS DOUBLE) AS value FROM {_SQL_QA} q) i WHERE value > 0 "
        f"UNION ALL SELECT 'AVERAGE_SCORE', NULL, CAST(round(avg(CAST(trim(Score) AS DOUBLE)), 2) AS DOUBLE) FROM {_SQL_QA} q "
        f"WHERE NOT {_sql_missing('Score')} AND {ok} HAVING count(*) > 0 "
        f"UNION ALL SELECT 'SCORE_DISTRIBUTION', CAST(CAST(trim(Score) AS DECIMAL(38, 0)) AS VARCHAR), CAST(count(*) AS DOUBLE) "
        f"FROM {_SQL_QA} q WHERE NOT {_sql_missing('Score')} AND {ok} GROUP BY CAST(trim(Score) AS DECIMAL(38, 0))"
    )



@register("qa_profile_report", _qa_report_sql())
def qa_profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _qa_posts(spark, sf_dir).select(*_QA_REPORT_COLS)
    return profile.qa_profile_report(posts, list(_QA_REPORT_COLS))
