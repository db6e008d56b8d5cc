"""Classifier queries: scores, reports, metrics, augmentation, training."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators import classify, folds, sample
from threadsift.plans.registry import register, sql_list
from threadsift.plans.tables import table

# --- scores: the sums of the two halves of a vector act as its two logits ---


def _scores(spark, sf_dir) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    half = F.floor(F.size("embedding") / 2).cast("int")
    add = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x)
    logits = F.array(add(F.slice("embedding", F.lit(1), half)), add(F.slice("embedding", half + 1, F.size("embedding"))))
    return classify.scores_from_logits(emb, logits, keep=["vec_id"])


_SQL_SCORES = """(SELECT vec_id, CAST(CASE WHEN pb > pa THEN 1 ELSE 0 END AS INTEGER) AS predicted,
   CASE WHEN pb > pa THEN 'non-technical' ELSE 'technical' END AS predicted_label,
   greatest(pa, pb) AS confidence
 FROM (SELECT vec_id, ea / (ea + eb) AS pa, eb / (ea + eb) AS pb FROM (
   SELECT vec_id, exp(a - greatest(a, b)) AS ea, exp(b - greatest(a, b)) AS eb FROM (
     SELECT vec_id, list_reduce(list_transform(embedding[1:len(embedding) // 2], lambda x: CAST(x AS DOUBLE)), lambda p, q: p + q) AS a,
     list_reduce(list_transform(embedding[len(embedding) // 2 + 1:], lambda x: CAST(x AS DOUBLE)), lambda p, q: p + q) AS b FROM embeddings) l) e) p)"""


# Registered outputs that come from exp(), float sums or interpolation are
# rounded to 9 decimals here (both engines), far below any reported digit;
# the library operators themselves keep full precision.
DIGITS = 9


@register("softmax_argmax", f"SELECT vec_id, predicted, round(confidence, {DIGITS}) AS confidence FROM {_SQL_SCORES} s")
def softmax_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("vec_id", "predicted", F.round("confidence", DIGITS).alias("confidence"))


@register("label_decode", f"SELECT vec_id, predicted_label FROM {_SQL_SCORES} s")
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("vec_id", "predicted_label")


@register("prediction_report", f"""
SELECT predicted_label, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), {DIGITS}) AS pct,
       round(avg(confidence), {DIGITS}) AS avg_confidence
FROM {_SQL_SCORES} s GROUP BY predicted_label
""")
def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = classify.prediction_report(_scores(spark, sf_dir))
    return rep.select("predicted_label", "n", F.round("pct", DIGITS).alias("pct"),
                      F.round("avg_confidence", DIGITS).alias("avg_confidence"))


@register("high_confidence", f"""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE confidence > 0.9) AS BIGINT) AS n_high,
       count(*) FILTER (WHERE confidence > 0.9) * 100.0 / count(*) AS pct_high
FROM {_SQL_SCORES} s
""")
def high_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.high_confidence(_scores(spark, sf_dir))


@register("label_share", f"""
SELECT predicted_label, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS DOUBLE) AS share
FROM {_SQL_SCORES} s GROUP BY predicted_label
""")
def label_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.label_share(_scores(spark, sf_dir))


@register("confidence_boxplot", f"""
WITH s AS (SELECT * FROM {_SQL_SCORES} x),
q AS (SELECT predicted_label, quantile_cont(confidence, 0.25) AS q1, quantile_cont(confidence, 0.5) AS median,
             quantile_cont(confidence, 0.75) AS q3 FROM s GROUP BY predicted_label)
SELECT q.predicted_label, round(q1, {DIGITS}) AS q1, round(median, {DIGITS}) AS median, round(q3, {DIGITS}) AS q3,
       min(confidence) FILTER (WHERE confidence >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(confidence) FILTER (WHERE confidence <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM s JOIN q ON s.predicted_label = q.predicted_label
GROUP BY q.predicted_label, q1, median, q3
""")
def confidence_boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = classify.confidence_boxplot(_scores(spark, sf_dir))
    return box.select("predicted_label", *[F.round(c, DIGITS).alias(c) for c in ("q1", "median", "q3")],
                      "whisker_low", "whisker_high")


# --- true labels: quality against a fixed length rule -----------------------
LONG_TEXT = 1000


def _labelled_docs(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    # J2 by key: predictions and true labels meet on the document id.
    joined = docs.join(labels, "doc_id")
    return joined.select("doc_id", "quality", "n_chars",
                         (F.col("n_chars") >= LONG_TEXT).cast("int").alias("predicted"))


@register("true_label_metrics", f"""
WITH s AS (SELECT d.doc_id, l.quality AS y, CASE WHEN d.n_chars >= {LONG_TEXT} THEN 1 ELSE 0 END AS yhat,
                  CAST(d.n_chars AS DOUBLE) AS score
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
             count(*) FILTER (WHERE y <> 1 AND yhat = 1) AS fp, count(*) FILTER (WHERE y = 1 AND yhat <> 1) AS fn,
             count(*) FILTER (WHERE y <> 1 AND yhat <> 1) AS tn FROM s),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM s),
a AS (SELECT (sum(avg_rank) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
             / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y <> 1)) AS roc_auc FROM r)
SELECT CAST(n AS BIGINT) AS n, (tp + tn) * 1.0 / n AS accuracy,
       coalesce(tp * 1.0 / nullif(tp + fp, 0), 0.0) AS precision,
       coalesce(tp * 1.0 / nullif(tp + fn, 0), 0.0) AS recall,
       coalesce(2.0 * (tp * 1.0 / nullif(tp + fp, 0)) * (tp * 1.0 / nullif(tp + fn, 0))
                / nullif((tp * 1.0 / nullif(tp + fp, 0)) + (tp * 1.0 / nullif(tp + fn, 0)), 0), 0.0) AS f1,
       CAST(roc_auc AS DOUBLE) AS roc_auc
FROM c, a
""")
def true_label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _labelled_docs(spark, sf_dir)
    return classify.binary_metrics(s, "quality", "predicted", "n_chars")


# --- synonym augmentation of benchmark items --------------------------------
# Fixed value: a small synonym table (word -> replacement; ``_`` joins words).
SYNONYMS = {
    "and": "plus",
    "the": "the",
    "it": "information_technology",
    "with": "along_with",
    "that": "which",
    "for": "for",
    "from": "from",
    "was": "was",
    "are": "are",
    "of": "of",
    "is": "be",
    "by": "past",
}


def _sql_syn_map() -> str:
    items = ", ".join(f"'{k}': '{v.replace('_', ' ')}'" for k, v in SYNONYMS.items())
    return "MAP {" + items + "}"


_SQL_AUG = f"""
WITH w AS (SELECT item_id, text, list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '') AS words FROM benchmark),
c AS (SELECT item_id, text, words,
        list_transform(list_slice(list_sort(list_transform(
          list_distinct(list_filter(words, lambda x: x IN {sql_list(SYNONYMS)})),
          lambda x: md5(CAST(item_id AS VARCHAR) || ':' || x) || '|' || x)), 1, 2), lambda x: substr(x, 34)) AS chosen
      FROM w)
SELECT item_id, false AS augmented, text FROM benchmark
UNION ALL
SELECT item_id, true AS augmented,
       array_to_string(list_transform(words, lambda x: CASE WHEN list_contains(chosen, x) THEN {_sql_syn_map()}[x] ELSE x END), ' ') AS text
FROM c
"""


@register("synonym_augment", _SQL_AUG)
def synonym_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark")
    return classify.augment_synonyms(bench, "text", "item_id", SYNONYMS, n=2)


@register("synonym_augment_table", _SQL_AUG)
def synonym_augment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark")
    # every word also has a later synonym, which is not the one to use
    several = [pair for k, v in SYNONYMS.items() for pair in ((k, v + "~"), (k, v))]
    syn = spark.createDataFrame(several, "word string, synonym string")
    return classify.augment_synonyms_table(bench, "text", "item_id", syn, n=2)


# --- train on labelled documents, score them --------------------------------
QUALITY_NAMES = ("low_quality", "high_quality")


def _trained_scores(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    folds = sample.stratified_folds(labels, "quality", "doc_id", 5)
    model = classify.train_text_classifier(docs.join(folds, "doc_id"), "text", "quality", "fold", num_folds=5)
    return classify.score_texts(model, docs, keep=["doc_id"], names=QUALITY_NAMES)


@register("train_score")
def train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    # model scores of every document; train_score_facts holds what SQL can check
    return _trained_scores(spark, sf_dir)


@register("train_score_facts", """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_documents,
       CAST(0 AS BIGINT) AS n_unknown_label, CAST(0 AS BIGINT) AS n_out_of_range FROM documents
""")
def train_score_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.col("predicted_label") == F.when(F.col("predicted") == 1, QUALITY_NAMES[1]).otherwise(QUALITY_NAMES[0])
    return _trained_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_documents"),
        F.count_if(~named).alias("n_unknown_label"),
        F.count_if(~F.col("confidence").between(0.5, 1.0)).alias("n_out_of_range"))


# --- the sums that all fold models are made of --------------------------------
FOLDS = 5
_SQL_FOLDS = f"""(SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1) % {FOLDS} AS INTEGER) AS fold
  FROM labels)"""


@register("fold_term_sums", f"""
WITH t AS (SELECT fold, quality AS label, list_filter(string_split_regex(lower(text), '[^a-zA-Z0-9_]+'), lambda w: w <> '') AS w
           FROM documents JOIN {_SQL_FOLDS} f USING (doc_id))
SELECT fold, label, CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS DOUBLE) AS tokens FROM t GROUP BY fold, label
""")
def fold_term_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and term counts by fold and label, from the sums that the fold models are made of."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = docs.join(sample.stratified_folds(labels, "quality", "doc_id", FOLDS), "doc_id")
    counted = PipelineModel(folds.text_stages("text", 1 << 18, stop_words=())).transform(labelled)
    sums = folds.term_counts(counted, "quality", "fold").groupBy("fold", "label").agg(F.sum("tf").alias("tokens"))
    rows = counted.groupBy("fold", F.col("quality").alias("label")).agg(F.count(F.lit(1)).alias("docs"))
    return rows.join(sums, ["fold", "label"], "left").select("fold", "label", "docs", "tokens")
