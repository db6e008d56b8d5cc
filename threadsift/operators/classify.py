"""Text classification: augmentation, training, scoring and reports.

Training is a Spark ML pipeline (tokenise, stop words, hashed term
frequencies, IDF, multinomial naive Bayes) evaluated by cross-validation on
a precomputed stratified fold column, so folds are reproducible and
balanced. All its models come from one aggregation pass (``folds``; an
iterative optimiser would scan the table once per iteration and fold). Scoring is ``PipelineModel.transform``: a narrow stage.

Reports are aggregates over the scored table. Quantiles and ROC AUC are
exact and come from value histograms (see ``quantiles``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col
from threadsift.operators.folds import cross_validate, text_stages
from threadsift.operators.quantiles import histogram_quantiles, roc_auc, value_histogram

# --- fixed values -----------------------------------------------------------
LABEL_NAMES = ("technical", "non-technical")
HIGH_CONFIDENCE = 0.9
# Phrases of the report.
REPORT_TITLE = "=== Text Classification Analysis Report ==="
REPORT_DATE = "Analysis Date: "
REPORT_OVERALL = "Overall Statistics:"
REPORT_TOTAL = "Total samples analyzed: %d"
REPORT_CLASS = "Content:"
REPORT_COUNT = "Count: %d"
REPORT_SHARE = "Percentage: %.1f%%"
REPORT_MEAN = "Average confidence: %.3f"
REPORT_SURE = "High Confidence Predictions:"
REPORT_HIGH = "Number of predictions with >90%% confidence: %d"
REPORT_HIGH_SHARE = "Percentage of high confidence predictions: %.1f%%"
# --------------------------------------------------------------------------
#: A frequent word's rows meet its synonym in so many tasks at least.
SALTS = 16


def softmax(logits) -> Column:
    """numerically stable softmax of an array of doubles."""
    arr = as_col(logits)
    shifted = F.transform(arr, lambda x: F.exp(x - F.array_max(arr)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def argmax(arr) -> Column:
    """0-based index of the first maximum."""
    a = as_col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def decode_label(index, names: Sequence[str] = LABEL_NAMES) -> Column:
    """Label id -> label name (fixed list lookup, no join)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), as_col(index) + 1)


def scores_from_logits(df: DataFrame, logits: Column, keep: Sequence[str] = (),
                       names: Sequence[str] = LABEL_NAMES) -> DataFrame:
    """X8 tail: ``keep..., predicted, predicted_label, confidence`` from logits."""
    probs = df.select(*keep, softmax(logits).alias("_p"))
    return probs.select(
        *keep, argmax("_p").alias("predicted"),
        decode_label(argmax("_p"), names).alias("predicted_label"),
        F.array_max("_p").alias("confidence"),
    )


def prediction_report(scored: DataFrame, label_col: str = "predicted_label",
                      conf_col: str = "confidence") -> DataFrame:
    """Per label: count, share of all rows in percent, mean confidence."""
    per = scored.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"), F.avg(conf_col).alias("avg_confidence"))
    # ``per`` has one row per label: the total window runs over a handful of rows.
    total = F.sum("n").over(Window.partitionBy())
    return per.select(label_col, "n", F.try_divide(F.col("n") * 100.0, total).alias("pct"), "avg_confidence")


def high_confidence(scored: DataFrame, conf_col: str = "confidence",
                    threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Rows with confidence strictly above the threshold, and their share."""
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(conf_col) > threshold).alias("n_high"),
    ).select("n", "n_high", F.try_divide(F.col("n_high") * 100.0, F.col("n")).alias("pct_high"))


def label_share(scored: DataFrame, label_col: str = "predicted_label") -> DataFrame:
    """Share per label in percent, one decimal (pie-chart data)."""
    per = scored.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # ``per`` has one row per label: the total window runs over a handful of rows.
    return per.select(label_col, F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 1).alias("share"))


def confidence_boxplot(scored: DataFrame, label_col: str = "predicted_label",
                       conf_col: str = "confidence") -> DataFrame:
    """Quartiles and 1.5-IQR whiskers per label (box-plot data).

    Whiskers are the most extreme values within 1.5 IQR of the box.
    """
    hist = value_histogram(scored, conf_col, [label_col])
    q = histogram_quantiles(hist, (0.25, 0.5, 0.75), [label_col])
    q = q.select(label_col, F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"))
    joined = hist.join(q, label_col)
    iqr = F.col("q3") - F.col("q1")
    return joined.groupBy(label_col, "q1", "median", "q3").agg(
        F.min(F.when(F.col("_v") >= F.col("q1") - 1.5 * iqr, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= F.col("q3") + 1.5 * iqr, F.col("_v"))).alias("whisker_high"),
    )


def binary_metrics(df: DataFrame, label_col: str, pred_col: str, score_col: str) -> DataFrame:
    """Accuracy, precision, recall, F1 (positive class 1) and ROC AUC in one row.

    Precision or recall with an empty denominator is 0, as in the usual
    metric libraries.
    """
    y, yhat = F.col(label_col) == 1, F.col(pred_col) == 1
    c = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y & yhat).alias("tp"),
               F.count_if(~y & yhat).alias("fp"), F.count_if(y & ~yhat).alias("fn"),
               F.count_if(~y & ~yhat).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return c.select(
        "n", F.try_divide(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
        roc_auc(df, score_col, label_col).scalar().alias("roc_auc"),
    )


def attach_by_position(left: DataFrame, right: DataFrame, pos_cols: Sequence[str] = ("file", "pos")) -> DataFrame:
    """Attach a parallel list (e.g. true labels) by position.

    Both sides come from ``read_text_lines_indexed``: the n-th line of the
    k-th file meets the n-th line of the k-th file. A position that only one
    side has fails the job (files of different number or length).
    """
    a, b = left.withColumn("_left", F.lit(True)), right.withColumn("_right", F.lit(True))
    joined = a.join(b, list(pos_cols), "full_outer")
    gap = F.raise_error(F.concat(
        F.lit("number of labels does not match number of texts: line "), F.col(pos_cols[-1]).cast("string"),
        F.lit(" of file "), F.col(pos_cols[0]).cast("string"), F.lit(" is on one side only")))
    checked = joined.where(F.when(F.col("_left") & F.col("_right"), F.lit(True)).otherwise(gap))
    return checked.drop("_left", "_right")


def _word_key(salt: str, id_col: str, word: Column) -> Column:
    """What decides which words of a row are replaced (a null id counts as an empty one)."""
    return F.md5(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), word))


def augment_synonyms(df: DataFrame, text_col: str, id_col: str, synonyms: Mapping[str, str],
                     n: int = 2, salt: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Originals plus one augmented copy of each row.

    In each text, up to ``n`` distinct words that have a synonym are replaced
    everywhere by it (``_`` in a synonym becomes a blank). Which words is
    decided per row by md5(id, word) order, so it is reproducible. Runs per
    row on a literal map: no shuffle. Output ``id, augmented, text`` and the columns in ``keep``.
    """
    if not synonyms:
        aug = df
    else:
        syn = F.create_map(*[x for k, v in synonyms.items() for x in (F.lit(k), F.lit(v.replace("_", " ")))])
        words = F.filter(F.split(F.trim(F.col(text_col)), r"(?U)\s+"), lambda w: w != "")
        cands = F.array_distinct(F.filter(words, lambda w: F.map_contains_key(syn, w)))
        keyed = F.array_sort(F.transform(
            cands, lambda w: F.concat(_word_key(salt, id_col, w), F.lit("|"), w)))
        chosen = F.transform(F.slice(keyed, 1, n), lambda x: F.substring(x, 34, 1 << 30))
        new = F.array_join(F.transform(words, lambda w: F.when(F.array_contains(chosen, w), syn[w]).otherwise(w)), " ")
        aug = df.withColumn(text_col, new)
    originals = df.select(id_col, F.lit(False).alias("augmented"), text_col, *keep)
    return originals.unionByName(aug.select(id_col, F.lit(True).alias("augmented"), text_col, *keep))


def train_text_classifier(df: DataFrame, text_col: str, label_col: str, fold_col: str,
                          num_folds: int = 5, smoothing: Sequence[float] = (1.0,),
                          num_features: int = 1 << 18, parallelism: int = 5, seed: int = 42,
                          model: str = "naive_bayes", reg_params: Sequence[float] = (0.01,),
                          max_iter: int = 30):
    """Pipeline evaluated by k-fold cross-validation on ``fold_col`` (ROC AUC).

    Folds come from the data (``sample.stratified_folds``). Naive Bayes gathers its statistics once for
    all folds (``folds.cross_validate``); of several ``smoothing`` values the best by mean fold AUC is
    fitted on all rows. ``model="logistic"`` uses logistic regression (one pass per iteration and fold,
    the training table persisted) with ``reg_params`` as the grid instead.
    """
    if model == "naive_bayes":
        return cross_validate(df, text_col, label_col, fold_col, num_folds, smoothing, num_features).final
    if model != "logistic":
        raise ValueError("model must be 'naive_bayes' or 'logistic'")
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import IDF
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    est = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter)
    grid = ParamGridBuilder().addGrid(est.regParam, list(reg_params)).build()
    pipe = Pipeline(stages=[*text_stages(text_col, num_features), IDF(inputCol="_tf", outputCol="features"), est])
    ev = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, foldCol=fold_col,
                        numFolds=num_folds, parallelism=parallelism, seed=seed)
    train = df.select(text_col, F.col(label_col).cast("double").alias(label_col), F.col(fold_col).cast("int"))
    train = train.persist()
    try:
        return cv.fit(train).bestModel
    finally:
        train.unpersist()


def score_texts(model, df: DataFrame, keep: Sequence[str] = (), names: Sequence[str] = LABEL_NAMES) -> DataFrame:
    """``keep..., predicted, predicted_label, confidence`` for every row."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    return out.select(*keep, argmax(probs).alias("predicted"), decode_label(argmax(probs), names).alias("predicted_label"),
                      F.array_max(probs).alias("confidence"))


def batch_scorer(make_predict_fn, num_labels: int = 2, batch_size: int = 8):
    """X8/UD5: wrap a user-supplied batch model as a Column function.

    ``make_predict_fn()`` runs once per Python worker and returns
    ``predict(texts: numpy array of str) -> numpy array (batch, num_labels)``
    of logits; Spark feeds it Arrow batches of ``batch_size`` rows. The
    logits then go through ``scores_from_logits`` (softmax, arg-max, label).
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    return predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()),
                             batch_size=batch_size, input_tensor_shapes=None)


def report_lines(report: DataFrame, high: DataFrame, when: str, names: Sequence[str] = LABEL_NAMES) -> DataFrame:
    """SNK7: the text report as ordered lines ``i, line`` (one small DataFrame, written once).

    Head and total, one numbered section per class in the order of ``names`` (a
    class without predictions counts zero), then the confident predictions.
    """
    spark = report.sparkSession

    def lines(df: DataFrame, *texts: Column) -> DataFrame:
        return df.select("i", F.posexplode(F.array(*texts)).alias("k", "line")).select(
            (F.col("i") * 10 + F.col("k")).alias("i"), "line")

    blank, last = F.lit(""), len(names) + 2
    overall = high.select(F.lit(0).alias("i"), "n")
    head = lines(overall, F.lit(REPORT_TITLE), blank, F.lit(REPORT_DATE + when), blank, F.lit(f"1. {REPORT_OVERALL}"),
                 F.format_string(REPORT_TOTAL, "n"), blank)
    classes = spark.createDataFrame([(i, n, f"{i}. {n.title()} {REPORT_CLASS}") for i, n in enumerate(names, 2)],
                                    "i int, predicted_label string, title string")
    found = classes.join(report, "predicted_label", "left")
    body = lines(found, F.col("title"), F.format_string(REPORT_COUNT, F.coalesce("n", F.lit(0))),
                 F.format_string(REPORT_SHARE, F.coalesce("pct", F.lit(0.0))),
                 F.format_string(REPORT_MEAN, F.coalesce("avg_confidence", F.lit(0.0))), blank)
    sure = high.select(F.lit(last).alias("i"), "n_high", F.coalesce("pct_high", F.lit(0.0)).alias("pct_high"))
    tail = lines(sure, F.lit(f"{last}. {REPORT_SURE}"), F.format_string(REPORT_HIGH, "n_high"),
                 F.format_string(REPORT_HIGH_SHARE, "pct_high"))
    return head.unionByName(body).unionByName(tail)


def augment_synonyms_table(df: DataFrame, text_col: str, id_col: str, synonyms: DataFrame,
                           n: int = 2, salt: str = "") -> DataFrame:
    """X6/J5 with a synonym table ``(word, synonym)`` of any size.

    Same result as ``augment_synonyms``, also for repeated and null ids. Every distinct (id, text) is
    known by a 128-bit hash. Its distinct words meet the table (of several synonyms of a word the first in text
    order counts), the ``n`` chosen by md5(id, word) order become a map, and the maps meet their
    rows by hash. No row's tokens are ever collected. Both joins also carry a
    salt: a word of every text is spread over ``SALTS`` tasks, and since neither aggregate is dealt by
    all join keys, each join side has an exchange of its own, which adaptive execution splits further when it is skewed.
    """
    words = F.array_remove(F.split(F.trim(F.col(text_col)), r"(?U)\s+"), "")
    row = ["_h1", "_h2"]
    hashed = df.withColumns({"_h1": F.xxhash64(F.lit(1), id_col, text_col), "_h2": F.xxhash64(F.lit(2), id_col, text_col),
                             "_part": F.pmod(F.xxhash64(F.lit(3), id_col, text_col), F.lit(SALTS)).cast("int")})
    toks = hashed.select(id_col, *row, "_part", F.explode(F.array_distinct(words)).alias("word"))
    syn = synonyms.groupBy("word").agg(F.regexp_replace(F.min("synonym"), "_", " ").alias("synonym"))
    salted = syn.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # a row's words once, however often it repeats
    found = toks.join(salted, ["word", "_part"]).withColumn("_key", _word_key(salt, id_col, F.col("word")))
    cand = found.select(*row, "word", "synonym", "_key").distinct()
    chosen = cand.withColumn("_r", F.row_number().over(Window.partitionBy(*row).orderBy("_key", "word")))
    maps = chosen.where(F.col("_r") <= n).groupBy(*row).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "synonym"))).alias("_m"))
    maps = maps.withColumn("_part", F.pmod(F.col("_h1"), F.lit(SALTS)).cast("int"))
    joined = hashed.withColumn("_part", F.pmod(F.col("_h1"), F.lit(SALTS)).cast("int")).join(maps, [*row, "_part"], "left")
    new = F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(F.col("_m"), w), w)), " ")
    aug = joined.select(id_col, F.lit(True).alias("augmented"), new.alias(text_col))
    originals = df.select(id_col, F.lit(False).alias("augmented"), text_col)
    return originals.unionByName(aug)


def cross_validate_augmented(df: DataFrame, text_col: str, label_col: str, fold_col: str, id_col: str,
                             synonyms: Mapping[str, str], k: int = 5, n_replace: int = 2,
                             num_features: int = 1 << 18):
    """X6 + X7 without leakage: per fold, augment the training side only, fit, score the held-out fold.

    Returns ``(best_model, aucs)`` where ``aucs[i]`` is the ROC AUC on fold
    ``i`` and ``best_model`` the fitted pipeline of the best fold (the source
    also keeps its best fold model). An augmented copy belongs to the fold of its row and is never
    scored, so one pass over rows and copies serves all folds (``folds.cross_validate``).
    """
    kept = df.select(id_col, text_col, label_col, fold_col)
    copies = augment_synonyms(kept.select(F.struct(id_col, label_col, fold_col).alias("row"), F.col(id_col).cast("string").alias("key"), text_col),
                              text_col, "key", synonyms, n=n_replace, keep=["row"]).where("augmented")
    rows = kept.select(id_col, text_col, label_col, fold_col, F.lit(False).alias("copy")).unionByName(
        copies.select("row.*", text_col, F.col("augmented").alias("copy")))
    found = cross_validate(rows, text_col, label_col, fold_col, k, num_features=num_features, training_only="copy")
    aucs = found.aucs[found.smoothing]
    best = max(range(k), key=lambda fold: -1.0 if aucs[fold] is None else aucs[fold])
    return found.folds[best], aucs
