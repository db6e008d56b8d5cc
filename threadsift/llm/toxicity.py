"""Toxicity classifier with counterfactual regularisation.

Method. Logistic regression over indicators of words,
word pairs and word beginnings. For each labelled
text that names a group, counterfactual twins are made by swapping the
identity terms for other groups'; the loss adds ``PENALTY`` times the squared
difference between the scores (log-odds) of text and twin. Weights that rest
on who is named therefore shrink, and neutral mentions of a group are not
taken for toxic ones. Features enter when their class frequencies differ
clearly in the sample, so that long texts do not gather noise.

The fit reads a bounded sample of the labelled rows in one task; the score
reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import arrays, features
from threadsift.llm.nbsvm import MODEL_SCHEMA, Model, fit_curve, logistic, score_column
from threadsift.llm.tables import temporary_name

THRESHOLD = 0.5
PENALTY = 1.0
TWINS = 2
RIDGE = 0.1
STEPS = 600
MIN_ROWS = 3
#: At most so many labelled rows are fitted.
MAX_LABELLED = 12_000
CLEAR = 4.0  # standard errors of the log-odds ratio

#: Terms that name groups of people; a twin swaps a term for one of the same line.
IDENTITY_TERMS = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "indigenous"),
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer", "heterosexual"),
    ("immigrant", "refugee", "foreigner", "migrant", "citizen", "native"),
    ("immigrants", "refugees", "foreigners", "migrants", "citizens", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("chinese", "mexican", "german", "french", "spanish", "russian", "indian", "turkish", "american"),
)


def _hashes(words) -> np.ndarray:
    texts = [w.encode() for w in words]
    ends = np.cumsum([len(t) for t in texts])
    return arrays.span_hashes(np.frombuffer(b"".join(texts), np.uint8), ends - [len(t) for t in texts], ends)


class Swapper:
    """Swaps identity terms among token hashes."""

    def __init__(self, groups=IDENTITY_TERMS):
        terms = [_hashes(group) for group in groups]
        self.terms = np.concatenate(terms)
        size = np.array([len(t) for t in terms])
        self.size = np.repeat(size, size)
        self.base = np.repeat(np.cumsum(size) - size, size)
        self.place = np.arange(len(self.terms)) - self.base
        self.order = np.argsort(self.terms)

    def swap(self, words: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """(words with every identity term moved on by ``turn``, flags of the changed words)."""
        at = np.searchsorted(self.terms[self.order], words)
        at[at == len(self.terms)] = 0
        term = self.order[at]
        changed = self.terms[term] == words
        step = 1 + (turn + np.zeros(len(words), np.int64)) % np.maximum(self.size[term] - 1, 1)
        other = self.terms[self.base[term] + (self.place[term] + step) % self.size[term]]
        return np.where(changed, other, words), changed


def extract(texts: pa.Array, swapper: Swapper, twins: int = TWINS) -> pa.Array:
    """Per text: its features, and those of each twin (empty if it names no group)."""
    data, offsets = arrays.text_buffer(texts)
    out = []
    for first, last in arrays.blocks(offsets):
        tokens = features.Tokens(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], False)
        own, changed = tokens.words, None
        lists = []
        for turn in range(twins + 1):
            if turn:
                tokens.words, changed = swapper.swap(own, turn - 1)
                named = np.unique(tokens.rows[changed])
            row, f = features.distinct(features.stem_features(tokens, changed))
            cuts = np.searchsorted(row, np.arange(last - first + 1))
            lists.append([f[cuts[r]:cuts[r + 1]] if not turn or r in set(named.tolist()) else f[:0] for r in range(last - first)])
        out += [{"x": own_x, "twins": [t for t in other if len(t)]} for own_x, *other in zip(*lists)]
    return pa.array(out, pa.struct([("x", pa.list_(pa.int32())), ("twins", pa.list_(pa.list_(pa.int32())))]))


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[np.ndarray], size: int):
        self.index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.count, self.size = len(rows), size

    def dot(self, weights):
        return np.bincount(self.row, weights[self.index], self.count)

    def back(self, values):
        return np.bincount(self.index, values[self.row], self.size)


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[int, np.ndarray]], size: int,
                 penalty: float = PENALTY, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of the regularised regression (gradient steps with momentum and scaling).

    ``pairs`` are (row number, features of a twin). The loss is the log loss,
    ``ridge / 2`` times the squared weights, and ``penalty / 2`` times the
    squared score differences of rows and twins.
    """
    x = _Rows(rows, size)
    plus = _Rows([rows[i] for i, _ in pairs], size)
    minus = _Rows([twin for _, twin in pairs], size)
    weights, bias = np.zeros(size), float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        error = logistic(x.dot(weights) + bias) - labels
        gradient = x.back(error) + ridge * weights
        if pairs:
            apart = plus.dot(weights) - minus.dot(weights)
            gradient += penalty * (plus.back(apart) - minus.back(apart))
        gradient = np.append(gradient, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) / (1 + step / 50)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def fit_rows(rows: list[np.ndarray], twins: list[list[np.ndarray]], labels: np.ndarray, penalty: float = PENALTY) -> Model:
    weights = np.zeros(features.DIMENSIONS)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(weights, 0.0, 0.0, float(np.log(rate / (1 - rate))))
    ones, n1 = np.zeros(features.DIMENSIONS), labels.sum()
    everyone, n = np.zeros(features.DIMENSIONS), len(labels)
    for row, label in zip(rows, labels):
        everyone[row] += 1
        if label:
            ones[row] += 1
    zeros, n0 = everyone - ones, n - n1
    odds = np.log((ones + 0.5) / (n1 - ones + 0.5)) - np.log((zeros + 0.5) / (n0 - zeros + 0.5))
    error = np.sqrt(1 / (ones + 0.5) + 1 / (n1 - ones + 0.5) + 1 / (zeros + 0.5) + 1 / (n0 - zeros + 0.5))
    kept = np.flatnonzero((everyone >= min(MIN_ROWS, max(1, n // 20))) & (np.abs(odds) >= CLEAR * error))
    at = np.full(features.DIMENSIONS, -1)
    at[kept] = np.arange(len(kept))
    local = lambda row: (lambda r: r[r >= 0])(at[row])
    pairs = [(i, local(twin)) for i, other in enumerate(twins) for twin in other]
    rows = [local(row) for row in rows]
    fitted, bias = fit_logistic(rows, labels, pairs, len(kept), penalty)
    margins = np.array([fitted[row].sum() for row in rows]) + bias
    slope, shift = fit_curve(margins, labels)
    weights[kept] = fitted
    return Model(weights, float(bias), slope, shift)


class ToxicityModel(Model):
    def scores(self, texts: pa.Array) -> np.ndarray:
        margins = features.linear_margins(texts, self.weights, self.bias, features.stem_features, False)
        return logistic(self.slope * margins + self.shift)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", text_col: str = "text", id_col: str = "doc_id",
        max_rows: int = MAX_LABELLED, groups=IDENTITY_TERMS, penalty: float = PENALTY) -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows outside fold 0.

    Without labels of both classes the score of every text is the (smoothed)
    rate of ones.
    """
    swapper = Swapper(groups)

    @F.arrow_udf("struct<x: array<int>, twins: array<array<int>>>")
    def featurise(texts: pa.Array) -> pa.Array:
        return extract(texts, swapper)

    def train(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([
            ("id", pa.string()), ("label", pa.int32()), ("x", pa.list_(pa.int32())), ("twins", pa.list_(pa.list_(pa.int32())))]))
        table = table.sort_by("id")
        rows = [np.asarray(x, np.int64) for x in table["x"].to_numpy()]
        twins = [[np.asarray(t, np.int64) for t in other] for other in table["twins"].to_pylist()]
        model = fit_rows(rows, twins, table["label"].to_numpy(), penalty)
        nonzero = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pylist([{
            "feature": nonzero.astype(np.int32).tobytes(), "weight": model.weights[nonzero].astype(np.float32).tobytes(),
            "bias": model.bias, "slope": model.slope, "shift": model.shift}],
            pa.schema([("feature", pa.binary()), ("weight", pa.binary()), ("bias", pa.float64()), ("slope", pa.float64()), ("shift", pa.float64())]))

    sample = features.labelled_sample(docs, labels, label_col, id_col, text_col, max_rows)
    rows = sample.select(F.col("id").cast("string").alias("id"), "label", featurise("text").alias("f"))
    row = rows.select("id", "label", "f.x", "f.twins").repartition(1).mapInArrow(train, MODEL_SCHEMA).first()
    weights = np.zeros(features.DIMENSIONS, np.float32)
    if row is None:  # no labelled rows at all
        return ToxicityModel(weights, 0.0, 0.0, 0.0)
    weights[np.frombuffer(row["feature"], np.int32)] = np.frombuffer(row["weight"], np.float32)
    return ToxicityModel(weights, row["bias"], row["slope"], row["shift"])


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column of scores; its name is returned.

    Texts are scored whole, whatever their length; null and empty ones get the score of no features, equal texts
    equal scores. Every row stays, also repeated ones, and so do all other columns.
    """
    name = temporary_name(docs, "score")
    return docs.withColumn(name, score_column(docs.sparkSession, model, F.col(text_col))), name
