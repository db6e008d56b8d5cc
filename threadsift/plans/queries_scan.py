"""Scans, filters, JSON, union, validation and range-sort queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.functions import text as T
from threadsift.functions.predicates import max_length, min_tokens
from threadsift.operators import sorting
from threadsift.plans.adapters import SQL_BODY, SQL_TITLE, body_col, title_col
from threadsift.plans.registry import register
from threadsift.plans.tables import table


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


@register("json_extract", """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events
""")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("event_id", T.parse_long(T.json_path("props", "$.k")).alias("k"))


@register("json_keyset_match", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(*) FILTER (WHERE list_sort(json_keys(props)) = ['k']) AS BIGINT) AS n_keyset_match
FROM events GROUP BY event_type
""")
def json_keyset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadsift.operators.profile import keyset_equals

    ev = _events(spark, sf_dir)
    match = keyset_equals("props", ["k"])
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(match).alias("n_keyset_match"),
    )


@register("event_filter_project", """
SELECT event_id, user_id, value, CAST(props->>'$.k' AS BIGINT) AS k
FROM events WHERE event_type = 'error' AND props->>'$.k' = '42'
""")
def event_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    # Projection and both equality filters; the column filter reaches the parquet scan.
    ev = ev.where((F.col("event_type") == "error") & (T.json_path("props", "$.k") == "42"))
    return ev.select("event_id", "user_id", "value", T.parse_long(T.json_path("props", "$.k")).alias("k"))


@register("shard_range_scan", """
SELECT event_id, strftime(ts, '%m%d') AS day, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'
""")
def shard_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadsift.sources.readers import day_range_filter

    ev = _events(spark, sf_dir)
    # SRC1/P3: the shard range '0105'..'0120' of 2024 as a pushed-down ts range.
    ev = ev.where(day_range_filter("ts", "2024-01-05", "2024-01-20"))
    return ev.select("event_id", F.date_format("ts", "MMdd").alias("day"), "event_type")


@register("union_all_periods", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'
""")
def union_all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")

    def extract(lo, hi):
        part = orders.where((F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
                            & (F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
                            & (F.col("o_orderstatus") == "F"))
        return part.select("o_orderkey", "o_custkey", "o_totalprice",
                           F.year("o_orderdate").alias("year"))

    # Bag union; each branch keeps its own pushed filters.
    return extract("1996-01-01", "1997-01-01").unionByName(extract("1997-01-01", "1998-01-01"))


@register("token_length_filter", f"""
SELECT doc_id, CAST(len(string_split(title, ' ')) AS INTEGER) AS title_tokens,
       CAST(len(string_split(body, ' ')) AS INTEGER) AS body_tokens,
       CAST(length(title) AS INTEGER) AS title_len, CAST(length(body) AS INTEGER) AS body_len
FROM (SELECT doc_id, {SQL_TITLE} AS title, {SQL_BODY} AS body FROM documents) d
WHERE len(string_split(body, ' ')) >= 10 AND len(string_split(title, ' ')) >= 5
  AND length(title) <= 400 AND length(body) <= 2000
""")
def token_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", title_col().alias("title"), body_col().alias("body"))
    kept = docs.where(min_tokens("body", 10) & min_tokens("title", 5)
                      & max_length("title", 400) & max_length("body", 2000))
    return kept.select(
        "doc_id",
        T.token_count("title").alias("title_tokens"), T.token_count("body").alias("body_tokens"),
        F.length("title").alias("title_len"), F.length("body").alias("body_len"),
    )


@register("segment_report", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment ORDER BY c_mktsegment
""")
def segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # P13 + O5/O10: a plain filter, and a report in a given order
    customers = table(spark, sf_dir, "customer", ["c_mktsegment", "c_acctbal"]).where(F.col("c_acctbal") > 0)
    return sorting.sorted_report(customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "c_mktsegment")


@register("range_sorted", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
""")
def range_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice")
    # O1: ten key ranges, each sorted; duplicates kept.
    return sorting.range_sorted(orders, "o_orderkey")


@register("micros_to_text", """
SELECT event_id, epoch_us(ts) AS micros, strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M:%S') AS time_text
FROM events
""")
def micros_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select("event_id", T.ntz_to_micros("ts").alias("micros"))
    return ev.select("event_id", "micros", T.micros_to_text("micros").alias("time_text"))


# Deterministic spoiling of text values so validators see every case; the
# variants depend on the last digit of the id, no rows are dropped.


def _datetime_text() -> F.Column:
    last = F.col("event_id") % 10
    two_digit = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    one_digit = F.format_string("%d-%d-%d %d:%d:%d", F.year("ts"), F.month("ts"), F.dayofmonth("ts"),
                                F.hour("ts"), F.minute("ts"), F.second("ts"))
    return (F.when(last == 0, F.concat(F.lit("junk-"), F.col("event_id").cast("string")))
            .when(last == 1, F.date_format("ts", "yyyy-MM-dd"))
            .when(last == 2, one_digit)
            .when(last == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(last == 4, F.substring(two_digit, 3, 30))  # a year of two digits
            .when(last == 5, F.concat(F.lit("0"), two_digit))  # and of five
            .otherwise(two_digit))


_DT_SQL = """CASE event_id % 10
  WHEN 0 THEN 'junk-' || CAST(event_id AS VARCHAR)
  WHEN 1 THEN strftime(ts, '%Y-%m-%d')
  WHEN 2 THEN format('{}-{}-{} {}:{}:{}', year(ts), month(ts), day(ts), hour(ts), minute(ts), CAST(floor(second(ts)) AS INTEGER))
  WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
  WHEN 4 THEN substr(strftime(ts, '%Y-%m-%d %H:%M:%S'), 3)
  WHEN 5 THEN '0' || strftime(ts, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""


@register("datetime_validate", f"""
SELECT event_id, s, regexp_matches(s, '^[0-9]{{4}}-') AND try_strptime(s, '%Y-%m-%d %H:%M:%S') IS NOT NULL AS is_valid,
       CASE WHEN regexp_matches(s, '^[0-9]{{4}}-') THEN strftime(try_strptime(s, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%dT%H:%M:%S') END AS iso
FROM (SELECT event_id, {_DT_SQL} AS s FROM events) x
""")
def datetime_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select("event_id", _datetime_text().alias("s"))
    return ev.select("event_id", "s", T.is_valid_datetime("s").alias("is_valid"), T.to_iso_datetime("s").alias("iso"))


def _int_text() -> F.Column:
    last = F.col("event_id") % 10
    uid = F.col("user_id").cast("string")
    return (F.when(last == 0, F.concat(F.lit("x"), uid))
            .when(last == 1, F.concat(F.lit(" "), uid, F.lit(" ")))
            .when(last == 2, F.concat(uid, F.lit(".5")))
            .when(last == 3, F.concat(F.lit("-"), uid))
            .when(last == 4, F.lit(""))
            .when(last == 5, F.concat(uid, F.lit("000000000")))  # beyond 32 bits
            .otherwise(uid))


_INT_SQL = """CASE event_id % 10
  WHEN 0 THEN 'x' || CAST(user_id AS VARCHAR)
  WHEN 1 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
  WHEN 2 THEN CAST(user_id AS VARCHAR) || '.5'
  WHEN 3 THEN '-' || CAST(user_id AS VARCHAR)
  WHEN 4 THEN ''
  WHEN 5 THEN CAST(user_id AS VARCHAR) || '000000000'
  ELSE CAST(user_id AS VARCHAR) END"""


@register("int_validate", f"""
SELECT event_id, s,
  CASE WHEN regexp_matches(trim(s), '^[+-]?[0-9]+$') THEN CAST(trim(s) AS BIGINT) END AS as_int
FROM (SELECT event_id, {_INT_SQL} AS s FROM events) x
""")
def int_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select("event_id", _int_text().alias("s"))
    return ev.select("event_id", "s", T.try_int("s").alias("as_int"))


@register("digits_validate", """
SELECT event_id, s, coalesce(regexp_matches(s, '^[0-9]+$'), false) AS is_digits
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN CAST(event_id AS VARCHAR) || 'a'
                            WHEN event_id % 10 = 1 THEN '' ELSE CAST(event_id AS VARCHAR) END AS s FROM events) x
""")
def digits_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.col("event_id") % 10
    s = (F.when(last == 0, F.concat(F.col("event_id").cast("string"), F.lit("a")))
         .when(last == 1, F.lit("")).otherwise(F.col("event_id").cast("string")))
    ev = _events(spark, sf_dir).select("event_id", s.alias("s"))
    return ev.select("event_id", "s", T.is_all_digits("s").alias("is_digits"))


@register("fill_defaults", """
SELECT event_id, coalesce(nullif(event_type, 'view'), '') AS kind,
       coalesce(CASE WHEN event_type = 'click' THEN NULL ELSE CAST(user_id AS VARCHAR) END, '0') AS score
FROM events
""")
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        F.when(F.col("event_type") != "click", F.col("user_id").cast("string")).alias("score"),
    )
    # Text gaps become '' and score gaps '0'.
    return ev.na.fill({"kind": "", "score": "0"})


@register("kind_split", """
SELECT lower(nullif(event_type, '')) AS kind, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
""")
def kind_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    # Rows per kind; a partitioned write splits files the same way.
    return ev.groupBy(T.lower_or_null("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
