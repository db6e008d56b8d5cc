"""Sampling, fold and sort queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadsift.operators import sample
from threadsift.plans.registry import register
from threadsift.plans.tables import table

SAMPLE_N = 100
TARGET_DIV = 4  # keep about a quarter of the text volume
FOLDS = 5


@register("random_sample")
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    # O3 by a seeded hash that SQL engines do not share: random_sample_facts
    # holds what SQL can check, hash_sample is the same operator on md5 keys
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sample.random_sample(docs, SAMPLE_N, seed=42)


@register("random_sample_facts", f"""
SELECT CAST(least(count(*), {SAMPLE_N}) AS BIGINT) AS n, CAST(least(count(*), {SAMPLE_N}) AS BIGINT) AS n_distinct,
       CAST(0 AS BIGINT) AS n_foreign FROM documents
""")
def random_sample_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    taken = sample.random_sample(docs, SAMPLE_N, seed=42)
    known = taken.join(docs.withColumn("known", F.lit(True)), ["doc_id", "source"], "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_distinct"),
                     F.count_if(F.col("known").isNull()).alias("n_foreign"))


@register("random_sample_shares", f"""
SELECT lang, count(*) AS n_rows, true AS fair FROM documents GROUP BY lang
""")
def random_sample_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    # O3 over rows that repeat: the share of each is within five standard deviations of its share of the table
    langs = table(spark, sf_dir, "documents").select("lang")
    taken = sample.random_sample(langs, SAMPLE_N, seed=42).groupBy("lang").agg(F.count(F.lit(1)).alias("taken"))
    rows = langs.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.col("n_rows") / rows.agg(F.sum("n_rows")).scalar()
    off = F.abs(F.coalesce("taken", F.lit(0)) - share * SAMPLE_N)
    return rows.join(taken, "lang", "left").select("lang", "n_rows", (off <= 5 * F.sqrt(share * (1 - share) * SAMPLE_N)).alias("fair"))


@register("shuffle_facts", """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT event_id) AS BIGINT) AS n_distinct, true AS same_order FROM events
""")
def shuffle_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A full shuffle keeps every row once, and its order does not depend on the layout
    events = table(spark, sf_dir, "events", ["event_id", "user_id"])

    def order(df: DataFrame) -> DataFrame:
        place = F.monotonically_increasing_id()
        return sample.full_shuffle(df, 7).withColumn("place", place).withColumn(
            "place", F.row_number().over(Window.partitionBy(F.col("event_id") % 64).orderBy("place")))

    one, two = order(events), order(events.repartition(5)).withColumnRenamed("place", "other")
    return one.join(two, ["event_id", "user_id"], "full_outer").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_distinct"),
        F.coalesce(F.bool_and(F.col("place") == F.col("other")), F.lit(True)).alias("same_order"))


@register("hash_sample", f"""
SELECT doc_id, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {SAMPLE_N}
""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sample.hash_sample(docs, SAMPLE_N, "doc_id")


@register("size_target_sample", f"""
SELECT doc_id FROM (
  SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         count(*) OVER () AS n, sum(n_chars) OVER () AS total
  FROM documents) t
WHERE rn <= floor(n * ((total // {TARGET_DIV}) / total))
""")
def size_target_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    target = F.floor(F.col("total") / TARGET_DIV)
    out = sample.size_target_sample(docs, F.col("n_chars"), target, "doc_id")
    return out.select("doc_id")


@register("stratified_folds", f"""
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1) % {FOLDS} AS INTEGER) AS fold
FROM labels
""")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sample.stratified_folds(labels, "quality", "doc_id", FOLDS)
