"""Quality classifier: support vectors over Naive Bayes features.

Method. Binary n-gram indicators are scaled by the log-count ratio of their
class frequencies (add-one smoothing), and a linear model with hinge loss is
fitted to the scaled rows by dual coordinate descent. Its weights are
interpolated with their mean magnitude, and a logistic curve fitted on rows
kept apart turns margins into scores.

The fit reads a bounded sample of the labelled rows (``MAX_LABELLED``, only
their distinct features) in one task; the score reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import features
from threadsift.llm.tables import temporary_name

MIN_ROWS = 3  # a feature counts from so many sampled rows on
COST = 1.0
EPOCHS = 20
INTERPOLATION = 0.25
CALIBRATION_SHARE = 5  # every fifth sampled row calibrates
THRESHOLD = 0.3

MODEL_SCHEMA = "feature binary, weight binary, bias double, slope double, shift double"


@dataclass
class Model:
    """``score = logistic(slope * margin + shift)`` over hashed indicators."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        margins = features.linear_margins(texts, self.weights, self.bias, features.style_features, True)
        return logistic(self.slope * margins + self.shift)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    counts = np.ones((2, size))
    for row, label in zip(rows, labels):
        counts[label, row] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, signs: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias; row i is ``values`` at its features and a constant one."""
    weights, bias = np.zeros(len(values)), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([1.0 + np.square(values[row]).sum() for row in rows])
    order = np.arange(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        largest = 0.0
        for i in order:
            x = values[rows[i]]
            gradient = signs[i] * (weights[rows[i]] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                weights[rows[i]] += step * x
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def fit_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve (Newton steps, smoothed targets)."""
    positive, negative = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 0.0, np.log((positive + 1) / (negative + 1))
    for _ in range(100):
        p = logistic(a * margins + b)
        g, w = p - target, np.maximum(p * (1 - p), 1e-9)
        ga, gb = g @ margins + 1e-3 * a, g.sum()
        haa, hab, hbb = w @ margins**2 + 1e-3, w @ margins, w.sum()
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of sampled rows (sorted distinct features each) and 0/1 labels."""
    weights = np.zeros(features.DIMENSIONS)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(weights, 0.0, 0.0, float(np.log(rate / (1 - rate))))
    seen = np.bincount(np.concatenate(rows), minlength=features.DIMENSIONS)
    kept = np.flatnonzero(seen >= min(MIN_ROWS, max(1, len(rows) // 20)))
    at = np.full(features.DIMENSIONS, -1)
    at[kept] = np.arange(len(kept))
    rows = [r[r >= 0] for r in (at[row] for row in rows)]
    apart = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart[:] = True  # too few rows to keep some apart
        fitted = apart
    else:
        fitted = ~apart
    train = [row for row, f in zip(rows, fitted) if f]
    ratio = log_count_ratio(train, labels[fitted], len(kept))
    scaled, bias = dual_coordinate_descent(train, ratio, np.where(labels[fitted] == 1, 1.0, -1.0))
    mean = np.abs(scaled).mean()
    scaled = (1 - INTERPOLATION) * mean + INTERPOLATION * scaled
    final = scaled * ratio
    margins = np.array([final[row].sum() for row, a in zip(rows, apart) if a]) + bias
    slope, shift = fit_curve(margins, labels[apart])
    weights[kept] = final
    return Model(weights, float(bias), slope, shift)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text",
        id_col: str = "doc_id", max_rows: int = features.MAX_LABELLED) -> Model:
    """Fit on a bounded sample of the labelled rows outside fold 0.

    Without labels of both classes the score of every text is the (smoothed)
    rate of ones.
    """

    @F.arrow_udf("array<int>")
    def extract(texts: pa.Array) -> pa.Array:
        return features.indicators(texts, features.style_features, True)

    def train(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("id", pa.string()), ("label", pa.int32()), ("x", pa.list_(pa.int32()))]))
        table = table.sort_by("id")
        rows = [np.asarray(x, np.int64) for x in table["x"].to_numpy()]
        model = fit_rows(rows, table["label"].to_numpy())
        nonzero = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pylist([{
            "feature": nonzero.astype(np.int32).tobytes(), "weight": model.weights[nonzero].astype(np.float32).tobytes(),
            "bias": model.bias, "slope": model.slope, "shift": model.shift}],
            pa.schema([("feature", pa.binary()), ("weight", pa.binary()), ("bias", pa.float64()), ("slope", pa.float64()), ("shift", pa.float64())]))

    sample = features.labelled_sample(docs, labels, label_col, id_col, text_col, max_rows)
    rows = sample.select(F.col("id").cast("string").alias("id"), "label", extract("text").alias("x"))
    row = rows.repartition(1).mapInArrow(train, MODEL_SCHEMA).first()
    weights = np.zeros(features.DIMENSIONS, np.float32)
    if row is None:  # no labelled rows at all
        return Model(weights, 0.0, 0.0, 0.0)
    weights[np.frombuffer(row["feature"], np.int32)] = np.frombuffer(row["weight"], np.float32)
    return Model(weights, row["bias"], row["slope"], row["shift"])


def score_column(spark, model, text):
    """Column of scores in 0..1 of a text column (null and empty texts get the score of no features)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts))

    return score(text)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column of scores; its name is returned.

    Texts are scored whole, whatever their length; null and empty ones get the score of no features, equal texts
    equal scores. Every row stays, also repeated ones, and so do all other columns.
    """
    name = temporary_name(docs, "score")
    return docs.withColumn(name, score_column(docs.sparkSession, model, F.col(text_col))), name


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns.

    A score at the threshold stays; copies of a text stay or go together; null texts count as empty ones.
    """
    scored, name = score(docs, model, text_col)
    return scored.where(F.col(name) >= threshold).select(docs.columns)
