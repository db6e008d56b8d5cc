"""License scans: a trained paragraph classifier, confirmed by templates.

Method. Paragraphs (lines up to the next one without a word, so a notice may
be wrapped) are read in overlapping windows of several sizes, so that a short
notice is not lost in the text around it. Windows become sparse word 1- to
3-grams; a multinomial logistic regression weighs each licence family against
``unknown``. It is trained on variations of the templates (words dropped,
text of the corpus around them) and on windows of sampled documents; its
probabilities are calibrated with a temperature, and the least probability
that counts is set per family on windows that share nothing with a template, so
that at most ``FALSE_ALARMS`` of them would pass. A family stands if one of its
templates agrees: at least ``SIMILARITY`` of the template's five-word shingles
(a shorter template is one shingle) occur in the window.

The fit reads a bounded sample of documents in one task; the thresholds and the
scan read every whole text, row by row, without a shuffle of texts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import arrays
from threadsift.llm.decontaminate import WORD
from threadsift.llm.tables import temporary_name

WINDOW, STEP = 96, 48  # words; a template is at most STEP words long
SCALES = ((WINDOW, STEP), (24, 12), (8, 4))
SHINGLE_WORDS = 5
SIMILARITY = 0.8
FALSE_ALARMS = 0.001
DIMENSIONS = 1 << 15
MAX_DOCUMENTS = 400
VARIATIONS = 60  # of each template
PARAGRAPHS = 3_000  # windows of the sampled documents, as many of each scale
STEPS = 120
BINS, RANGE = 240, 12.0  # of log odds; beyond the range is the first or last bin
MOST = 0.99  # a family at this probability always counts

UNKNOWN = "unknown"
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "lgpl": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "proprietary": ("All rights reserved.", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means",),
}

RESULT = "array<struct<family: string, probability: double, similarity: double, start: bigint, end: bigint>>"


def _words(data: np.ndarray, offsets: np.ndarray):
    """(hashes, first word of each row and total, first word of each paragraph and total)."""
    starts, ends = arrays.runs(WORD[data], offsets[:-1])
    hashes = arrays.span_hashes(arrays.ASCII_LOWER[data], starts, ends)
    rows = arrays.word_rows(starts, offsets)
    lines = np.cumsum(data == 0x0A)[starts] if len(starts) else starts
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = lines[1:] > lines[:-1] + 1
    new[rows] = True
    return hashes, rows, np.flatnonzero(new)


def windows(paragraphs: np.ndarray, window: int = WINDOW, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the windows of all paragraphs, in order."""
    first, last = paragraphs[:-1], paragraphs[1:]
    count = np.maximum(1, -(-(last - first - (window - step)) // step))
    turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = np.repeat(first, count) + turn * step
    return starts, np.minimum(starts + window, np.repeat(last, count))


def scaled_windows(paragraphs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The windows of each scale; those of a paragraph that is one larger window or less are not repeated."""
    out = [windows(paragraphs)]
    for window, step in SCALES[1:]:
        starts, ends = windows(paragraphs, window, step)
        whole = np.isin(starts, paragraphs) & np.isin(ends, paragraphs)
        out.append((starts[~whole], ends[~whole]))
    return out


def _features(words: np.ndarray, k: int) -> np.ndarray:
    """Hashed feature of the k-gram at each word (the last k - 1 words have none)."""
    return (arrays.gram_hashes(words, k) >> np.uint64(64 - 15)).astype(np.int64)


def text_words(text: str) -> np.ndarray:
    data, offsets = arrays.text_buffer(pa.array([text]))
    return _words(data, offsets)[0]


def shingles(words: np.ndarray) -> np.ndarray:
    return np.unique(arrays.gram_hashes(words, min(SHINGLE_WORDS, len(words))))


@dataclass
class Model:
    families: list[str]  # the first is unknown
    weights: np.ndarray  # features x families
    bias: np.ndarray
    temperature: float
    thresholds: np.ndarray  # least bin of each family but unknown

    def log_odds(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Calibrated log odds of each family against unknown for windows of a word sequence."""
        total = np.zeros((len(starts), len(self.families)))
        size = np.zeros(len(starts))
        for k in range(1, 4):
            f = _features(words, k)
            sums = np.zeros((len(f) + 1, len(self.families)))
            np.cumsum(self.weights[f], axis=0, out=sums[1:], dtype=np.float64)
            stops = np.maximum(np.minimum(ends - (k - 1), len(f)), np.minimum(starts, len(f)))
            begins = np.minimum(starts, len(f))
            total += sums[stops] - sums[begins]
            size += stops - begins
        margins = (total / np.sqrt(np.maximum(size, 1))[:, None] + self.bias) / self.temperature
        return margins[:, 1:] - margins[:, :1]


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bins(log_odds: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((log_odds + RANGE) * (BINS / (2 * RANGE))), 0, BINS - 1).astype(np.int64)


def thresholds(unknown: np.ndarray) -> np.ndarray:
    """Per family the least bin from which on at most ``FALSE_ALARMS`` of the unknown windows pass.

    ``unknown`` counts them by family and bin. No threshold is above ``MOST``.
    """
    above = np.cumsum(unknown[:, ::-1], axis=1)[:, ::-1]
    least = (above > np.floor(FALSE_ALARMS * above[:, :1])).sum(axis=1)
    return np.minimum(least, bins(np.log(np.array(MOST / (1 - MOST)))))


class Templates:
    """The shingles of all templates, to be found in word sequences."""

    def __init__(self, templates=None):
        templates = templates or TEMPLATES
        texts = [(f, text_words(t)) for f in sorted(templates) for t in templates[f]]
        made = [(min(SHINGLE_WORDS, len(w)), shingles(w)) for _, w in texts]
        self.known = {k: np.unique(np.concatenate([x for size, x in made if size == k])) for k in sorted({k for k, _ in made})}
        self.first, total = {}, 0
        for k, known in self.known.items():
            self.first[k], total = total, total + len(known)
        self.member = np.zeros((total, len(made)))  # shingles x templates
        for t, (k, x) in enumerate(made):
            self.member[self.first[k] + np.searchsorted(self.known[k], x), t] = 1 / len(x)
        self.family_first = np.unique([f for f, _ in texts], return_index=True)[1]

    def similarities(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows with a shingle of any template and, for each of them and each family, the largest share of a
        template's shingles that occur in the window."""
        at, which, size = [], [], []
        for k, known in self.known.items():
            grams = arrays.gram_hashes(words, k)
            place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            here = np.flatnonzero(known[place] == grams)
            at.append(here)
            which.append(self.first[k] + place[here])
            size.append(np.full(len(here), k))
        at, which, size = np.concatenate(at), np.concatenate(which), np.concatenate(size)
        order = np.argsort(at, kind="stable")
        at, which, size = at[order], which[order], size[order]
        low = np.searchsorted(at, starts)
        count = np.searchsorted(at, ends) - low
        window = np.repeat(np.arange(len(starts)), count)
        hit = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        inside = at[hit] + size[hit] <= ends[window]
        pairs = np.unique(window[inside] * len(self.member) + which[hit[inside]])
        window, first = np.unique(pairs // len(self.member), return_index=True)
        if not len(window):
            return window, np.zeros((0, len(self.family_first)))
        shares = np.add.reduceat(self.member[pairs % len(self.member)], first, axis=0)
        has = self.member > 0
        for i, (a, b) in enumerate(zip(first, [*first[1:], len(pairs)])):  # found words that a better template explains do not count
            near = np.flatnonzero(shares[i] >= SIMILARITY - 1e-9)
            if len(near) > 1:
                here = has[pairs[a:b] % len(self.member)][:, near]
                within = ~(here[:, :, None] & ~here[:, None, :]).any(axis=0)
                worse = shares[i, near][:, None] < shares[i, near][None, :]
                shares[i, near[(within & worse).any(axis=1)]] = 0
        return window, np.maximum.reduceat(shares, self.family_first, axis=1)


class Scanner:
    def __init__(self, model: Model, templates=None):
        self.model = model
        self.templates = Templates(templates)

    def blocks(self, texts: pa.Array):
        """(rows, words, first word of each row, first word of each paragraph, window starts, window ends) of each block."""
        data, offsets = arrays.text_buffer(texts)
        for first, last in arrays.blocks(offsets, 1 << 18):
            words, rows, paragraphs = _words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
            scales = scaled_windows(paragraphs) if len(words) else [(paragraphs[:0], paragraphs[:0])]
            yield last - first, words, rows, paragraphs, *map(np.concatenate, zip(*scales))

    def unknown(self, texts: pa.Array) -> np.ndarray:
        """Number of windows without a shingle of any template, by family and bin."""
        total = np.zeros((len(self.model.families) - 1, BINS), np.int64)
        for _, words, _, _, starts, ends in self.blocks(texts):
            if len(words):
                other = np.delete(np.arange(len(starts)), self.templates.similarities(words, starts, ends)[0])
                found = bins(self.model.log_odds(words, starts[other], ends[other])) + np.arange(len(total)) * BINS
                total += np.bincount(found.ravel(), minlength=total.size).reshape(total.shape)
        return total

    def scan(self, texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        for count, words, rows, paragraphs, starts, ends in self.blocks(texts):
            found: list[dict[tuple, dict]] = [{} for _ in range(count)]
            near, similarity = self.templates.similarities(words, starts, ends) if len(words) else ([], None)
            if len(near):  # only these can be confirmed
                starts, ends = starts[near], ends[near]
                odds = self.model.log_odds(words, starts, ends)
                passed = (similarity >= SIMILARITY - 1e-9) & (bins(odds) >= self.model.thresholds)
                probability = 1 / (1 + np.exp(-odds))
                row = np.searchsorted(rows, starts, side="right") - 1
                paragraph = np.searchsorted(paragraphs, starts, side="right") - 1
                for w, f in zip(*(x.tolist() for x in np.nonzero(passed))):
                    r, family = row[w], self.model.families[f + 1]
                    one = {"family": family, "probability": float(probability[w, f]), "similarity": float(similarity[w, f]),
                           "start": int(starts[w] - rows[r]), "end": int(ends[w] - rows[r])}
                    old = found[r].setdefault((paragraph[w], family), one)  # windows of a paragraph that agree are one finding
                    for name, better in (("probability", max), ("similarity", max), ("start", min), ("end", max)):
                        old[name] = better(old[name], one[name])
            out += [sorted(x.values(), key=lambda y: y["start"]) for x in found]
        return pa.array(out, pa.list_(pa.struct([("family", pa.string()), ("probability", pa.float64()),
                                                 ("similarity", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])))


class _Rows:
    """Sparse rows: counts of features, divided by the root of their number."""

    def __init__(self, rows: list[np.ndarray]):
        grams = [np.concatenate([_features(w, k) for k in range(1, 4)]) for w in rows]
        self.index = np.concatenate(grams)
        size = np.array([len(g) for g in grams])
        self.value = np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)[:, None]
        self.first = np.cumsum(size) - size
        self.order = np.argsort(self.index, kind="stable")
        self.row = np.repeat(np.arange(len(rows)), size)
        self.columns, self.column_first = np.unique(self.index[self.order], return_index=True)

    def dot(self, weights):
        return np.add.reduceat(weights[self.index] * self.value, self.first, axis=0)

    def back(self, values, out):
        spread = (values[self.row] * self.value)[self.order]
        out[self.columns] += np.add.reduceat(spread, self.column_first, axis=0)


def fit_words(corpus: list[np.ndarray], templates=None, seed: int = 5) -> Model:
    """The model from unknown paragraphs (word hashes) and variations of the templates."""
    templates = templates or TEMPLATES
    random = np.random.default_rng(seed)
    families = [UNKNOWN, *sorted(templates)]
    known = Templates(templates).known
    corpus = [w for w in corpus if len(w) and not any(np.isin(arrays.gram_hashes(w, k), x).any() for k, x in known.items())]
    if not corpus:
        corpus = [text_words("some other paragraph without a licence")]
    pool = np.concatenate(corpus)
    rows = [w[:WINDOW] for w in corpus]
    labels = [0] * len(rows)
    for label, family in enumerate(families[1:], 1):
        for text in templates[family]:
            words = text_words(text)
            for turn in range(VARIATIONS):
                kept = words if turn % 3 == 0 else words[random.random(len(words)) > 0.08]
                room = [window - len(kept) for window, _ in SCALES if window >= len(kept)]
                around = int(random.integers(0, room[turn % len(room)] + 1)) if turn % 4 else 0
                at = int(random.integers(0, max(1, len(pool) - around)))
                before = int(random.integers(0, around + 1))
                rows.append(np.concatenate([pool[at:at + before], kept, pool[at + before:at + around]]))
                labels.append(label)
    labels = np.array(labels)
    apart = np.arange(len(rows)) % 5 == 0
    x = _Rows([r for r, a in zip(rows, apart) if not a])
    y = np.eye(len(families))[labels[~apart]]
    weights, bias = np.zeros((DIMENSIONS, len(families))), np.zeros(len(families))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        error = softmax(x.dot(weights) + bias) - y
        gradient = 0.02 * weights
        x.back(error, gradient)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) / (1 + step / 40)
        bias -= 0.5 * error.mean(axis=0)
    margins = _Rows([r for r, a in zip(rows, apart) if a]).dot(weights) + bias
    truth = labels[apart]
    loss = lambda t: -np.log(softmax(margins / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    odds = bins((margins[:, 1:] - margins[:, :1]) / temperature)[truth == 0]
    unknown = np.stack([np.bincount(o, minlength=BINS) for o in odds.T])
    return Model(families, weights.astype(np.float32), bias, temperature, thresholds(unknown))


def fit(docs: DataFrame, text_col: str = "text", max_documents: int = MAX_DOCUMENTS) -> Model:
    """Fit on the windows of at most ``max_documents`` distinct texts (the first by a hash of the text); thresholds are
    those of all texts.

    Null and empty texts have no windows; of a long text every window counts, copies of a text count once in
    the fit and each in the thresholds. Without texts the model knows the templates and one made-up unknown paragraph.
    """

    def train(batches):
        scales = [{} for _ in SCALES]  # distinct windows
        for batch in batches:
            data, offsets = arrays.text_buffer(batch.column(0))
            for first, last in arrays.blocks(offsets):
                words, _, cuts = _words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                for seen, (starts, ends) in zip(scales, scaled_windows(cuts) if len(words) else []):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words, dtype=np.uint64)])
                    order = arrays.mix(sums[ends] - sums[starts])  # does not depend on how the texts arrive
                    for i in np.argsort(order)[:PARAGRAPHS].tolist():
                        seen.setdefault(int(order[i]), words[starts[i]:ends[i]].copy())
        each = PARAGRAPHS // len(SCALES)
        model = fit_words([seen[h] for seen in scales for h in sorted(seen)[:each]])
        yield pa.RecordBatch.from_pylist([{"weights": model.weights.tobytes(), "bias": model.bias.tobytes(),
                                           "temperature": model.temperature, "thresholds": model.thresholds.tobytes()}],
                                         pa.schema([("weights", pa.binary()), ("bias", pa.binary()),
                                                    ("temperature", pa.float64()), ("thresholds", pa.binary())]))

    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    order = F.xxhash64("text")
    last = texts.select(order.alias("h")).distinct().orderBy("h").limit(max_documents).agg(F.max("h")).first()[0]
    sample = texts.where(order <= F.lit(last)).groupBy(order.alias("h")).agg(F.min("text").alias("text")).select("text")
    row = sample.repartition(1).mapInArrow(train, "weights binary, bias binary, temperature double, thresholds binary").first()
    families = [UNKNOWN, *sorted(TEMPLATES)]
    if row is None:  # no texts
        return fit_words([])
    weights = np.frombuffer(row["weights"], np.float32).reshape(DIMENSIONS, len(families))
    model = Model(families, weights, np.frombuffer(row["bias"]), row["temperature"],
                  np.frombuffer(row["thresholds"], np.int64))
    return calibrated(texts, model)


def calibrated(texts: DataFrame, model: Model) -> Model:
    """``model`` with thresholds from the windows of all texts (one column, ``text``)."""
    scanner = texts.sparkSession.sparkContext.broadcast(Scanner(model))
    shape = len(model.families) - 1, BINS

    def counted(batches):
        total = np.zeros(shape, np.int64)
        for batch in batches:
            total += scanner.value.unknown(batch.column(0))
        family, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(family), pa.array(at), pa.array(total[family, at])], ["family", "bin", "n"])

    unknown = np.zeros(shape, np.int64)
    for r in texts.mapInArrow(counted, "family bigint, bin bigint, n bigint").groupBy("family", "bin").agg(F.sum("n").alias("n")).collect():
        unknown[r["family"], r["bin"]] = r["n"]
    return replace(model, thresholds=thresholds(unknown)) if unknown.any() else model


def scan(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): array of findings.

    A finding is (family, probability, similarity, start, end), the place in
    words; null and empty texts have none. Texts are read whole, whatever their length; repeated rows each
    get their findings, other columns stay.
    """
    name = temporary_name(docs, "licenses")
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(model))

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        return scanner.value.scan(texts)

    return docs.withColumn(name, found(F.col(text_col))), name
