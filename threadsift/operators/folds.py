"""Cross-validation of the text classifier from statistics that add up.

Multinomial naive Bayes over TF-IDF needs sums only: documents and term counts per label, and
documents per term. They are gathered once, by fold, label and term; what a fold's
model must not see is subtracted, so the k models of a cross-validation and the final one
cost one pass over the texts instead of k + 1. Inverse document frequencies follow
from the same sums. Each model is fitted by Spark ML on one weighted row a label.

The sums are sparse while they are gathered (a partial aggregate per task); at most
``folds * labels * num_features`` rows reach the driver, whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import ElementwiseProduct, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.operators.quantiles import roc_auc

TOKEN_GAPS = r"\W+"


def text_stages(text_col: str, num_features: int, stop_words: Sequence[str] | None = None) -> list:
    """Tokens, stop words (Spark's English list unless given) and hashed term counts ``_tf``."""
    stop = StopWordsRemover(inputCol="_tokens", outputCol="_words")
    if stop_words is not None:
        stop.setStopWords(list(stop_words))
    return [RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_GAPS, toLowercase=True), stop,
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features)]


@dataclass
class FoldStatistics:
    """``docs[fold, label]``, and by term ``tf[fold, label, term]`` and ``df[fold, term]``."""

    docs: np.ndarray
    tf: np.ndarray
    df: np.ndarray

    def without(self, fold: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents and term counts by label, and documents by term, of all folds but ``fold``."""
        parts = [x.sum(axis=0) for x in (self.docs, self.tf, self.df)]
        return tuple(parts) if fold is None else tuple(p - x[fold] for p, x in zip(parts, (self.docs, self.tf, self.df)))


def term_counts(counted: DataFrame, label_col: str, fold_col: str) -> DataFrame:
    """``fold, label, term, tf, df``: the sums, for documents with a ``_tf`` vector."""
    vector = F.unwrap_udt("_tf")
    terms = counted.select(fold_col, label_col, F.explode(F.arrays_zip(vector["indices"], vector["values"])).alias("t"))
    return terms.groupBy(F.col(fold_col).alias("fold"), F.col(label_col).alias("label"), F.col("t.indices").alias("term")).agg(
        F.sum("t.values").alias("tf"), F.count(F.lit(1)).alias("df"))


def fold_statistics(counted: DataFrame, label_col: str, fold_col: str, num_folds: int, num_features: int,
                    num_labels: int = 2) -> FoldStatistics:
    """The sums of a table with ``_tf``, label (0 ..) and fold (0 ..) columns."""
    docs = np.zeros((num_folds, num_labels))
    for r in counted.groupBy(fold_col, label_col).count().collect():
        docs[int(r[0]), int(r[1])] = r[2]
    tf, df = np.zeros((num_folds, num_labels, num_features)), np.zeros((num_folds, num_features))
    found = term_counts(counted, label_col, fold_col).toPandas()
    at = (found["fold"].to_numpy(int), found["label"].to_numpy(int), found["term"].to_numpy(int))
    tf[at] = found["tf"]
    np.add.at(df, (at[0], at[2]), found["df"].to_numpy())
    return FoldStatistics(docs, tf, df)


def _model(spark, statistics: FoldStatistics, left_out: int | None, smoothing: float) -> list:
    """The IDF scaling and the naive Bayes model of all folds but one (or of all)."""
    docs, tf, df = statistics.without(left_out)
    idf = np.log((docs.sum() + 1) / (df + 1))
    labels = [c for c in range(len(docs)) if docs[c]]
    # one row a label, weighted with its documents: the sums are those of the documents themselves
    rows = [(float(c), float(docs[c]), Vectors.dense(tf[c] * idf / docs[c])) for c in labels]
    table = spark.createDataFrame(rows, ["label", "weight", "features"])
    bayes = NaiveBayes(featuresCol="features", labelCol="label", weightCol="weight", modelType="multinomial", smoothing=smoothing)
    return [ElementwiseProduct(inputCol="_tf", outputCol="features", scalingVec=Vectors.dense(idf)), bayes.fit(table)]


@dataclass
class CrossValidation:
    """``folds[i]`` never saw fold i; ``final`` saw all rows. Both at the smoothing with the best mean of ``aucs``."""

    smoothing: float
    aucs: dict[float, list[float | None]]
    folds: list[PipelineModel]
    final: PipelineModel


def cross_validate(df: DataFrame, text_col: str, label_col: str, fold_col: str, num_folds: int,
                   smoothing: Sequence[float] = (1.0,), num_features: int = 1 << 18, training_only: str | None = None,
                   stop_words: Sequence[str] | None = None) -> CrossValidation:
    """Naive Bayes models of every fold and of all rows, with exact ROC AUC by fold.

    Rows where the column ``training_only`` is true (augmented copies) train the other folds' models but are not
    scored. A fold's AUC ranks its rows by the difference of the two labels' log probabilities.
    """
    spark = df.sparkSession
    head = text_stages(text_col, num_features, stop_words)
    own = F.col(training_only) if training_only else F.lit(False)
    counted = PipelineModel(head).transform(df).select(
        F.col(label_col).cast("double").alias("label"), F.col(fold_col).cast("int").alias("fold"), own.alias("training_only"), "_tf")
    counted = counted.persist()
    try:
        statistics = fold_statistics(counted, "label", "fold", num_folds, num_features)
        tails = {s: [_model(spark, statistics, fold, s) for fold in range(num_folds)] for s in smoothing}
        scored = None
        for s, models in tails.items():
            for fold, stages in enumerate(models):
                held = PipelineModel(stages).transform(counted.where((F.col("fold") == fold) & ~F.col("training_only")))
                raw = vector_to_array("rawPrediction")
                part = held.select(F.lit(s).alias("smoothing"), "fold", "label", (raw[1] - raw[0]).alias("margin"))
                scored = part if scored is None else scored.unionByName(part)
        found = {(r["smoothing"], r["fold"]): r["roc_auc"] for r in roc_auc(scored, "margin", "label", ["smoothing", "fold"]).collect()}
    finally:
        counted.unpersist()
    aucs = {s: [found.get((s, fold)) for fold in range(num_folds)] for s in smoothing}
    best = max(smoothing, key=lambda s: np.mean([a for a in aucs[s] if a is not None] or [0.0]))
    return CrossValidation(best, aucs, [PipelineModel([*head, *stages]) for stages in tails[best]],
                           PipelineModel([*head, *_model(spark, statistics, None, best)]))
