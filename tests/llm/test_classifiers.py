import random
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.conftest import EMPTY, words
from threadsift.llm import features, nbsvm, toxicity


def corpus(n=400, bad=0.25):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text = words(i, r.randint(30, 120))
        poor = r.random() < bad
        if poor:
            text = " ".join(w + r.choice(["%%%", "###"]) for w in text.split())
        rows.append((i, text))
        labels.append((i, int(not poor), int(poor)))
    return rows, labels


def test_quality_on_held_out_rows(spark, frame, tricky):
    rows, labels = corpus()
    df = frame(rows + [(i and i + 10_000, t) for i, t in tricky])
    label = spark.createDataFrame(labels + labels[:5] + [(None, 1, 0), (7, None, None)], "doc_id bigint, quality int, toxic int")
    model = nbsvm.fit(df, label)
    scored, name = nbsvm.score(df, model)
    score = {r["doc_id"]: r[name] for r in scored.collect()}
    assert len(score) and all(0 <= s <= 1 for s in score.values())
    held = [(score[i], q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= nbsvm.THRESHOLD) == q for s, q in held]) > 0.95
    kept = nbsvm.keep_good(df, model)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()


def test_dual_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(1)
    rows = [np.flatnonzero(r.random(12) < 0.4) for _ in range(60)]
    values = r.normal(size=12)
    signs = np.where(r.random(60) < 0.5, 1.0, -1.0)
    w, b = nbsvm.dual_coordinate_descent(rows, values, signs, epochs=3000)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + sum(max(0, 1 - s * (w[x] @ values[x] + b)) for x, s in zip(rows, signs))

    best = loss(w, b)
    for _ in range(200):
        assert best <= loss(w + r.normal(size=12) * 0.02, b + r.normal() * 0.02) + 1e-3


def test_log_count_ratio():
    ratio = nbsvm.log_count_ratio([np.array([0, 1]), np.array([1])], np.array([1, 0]), 3)
    p, q = np.array([2, 2, 1]) / 5, np.array([1, 2, 1]) / 4
    assert np.allclose(ratio, np.log(p / q))


def test_toxicity_and_counterfactual_penalty():
    r = random.Random(3)
    insults, groups = ["zorgo", "blimp", "frak"], ["muslim", "christian", "jewish"]
    texts, labels = [], []
    for i in range(600):
        w = words(i, 30).split()
        toxic = r.random() < 0.3
        if toxic:
            w[r.randrange(30)] = r.choice(insults)
        if r.random() < (0.7 if toxic else 0.03):  # one group is named with insults more often
            w[r.randrange(30)] = "muslim"
        elif r.random() < 0.3:
            w[r.randrange(30)] = r.choice(groups[1:])
        texts.append(" ".join(w))
        labels.append(int(toxic))
    rows = toxicity.extract(pa.array(texts), toxicity.Swapper()).to_pylist()
    x = [np.array(r["x"], np.int64) for r in rows]
    twins = [[np.array(t, np.int64) for t in r["twins"]] for r in rows]
    assert any(twins) and not all(twins)
    probe = pa.array([words(9999, 20) + " muslim", words(9999, 20) + " jewish", words(9999, 20) + " zorgo", ""])
    gaps, hits = [], []
    for penalty in (0.0, 20.0):
        m = toxicity.fit_rows(x, twins, np.array(labels), penalty)
        s = toxicity.ToxicityModel(m.weights, m.bias, m.slope, m.shift).scores(probe)
        gaps.append(abs(s[0] - s[1]))
        hits.append(s[2])
    assert gaps[1] < 0.05 and gaps[1] < gaps[0] and hits[1] > 0.5


def test_toxicity_query_path(spark, frame, tricky):
    rows, labels = corpus()
    df = frame(rows + [(i and i + 10_000, t) for i, t in tricky])
    label = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    scored, name = toxicity.score(df, toxicity.fit(df, label))
    score = {r["doc_id"]: r[name] for r in scored.collect()}
    held = [(score[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= toxicity.THRESHOLD) == t for s, t in held]) > 0.95


def test_without_labels_or_documents(spark, frame):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    df = frame([(1, "a b c"), (2, None)])
    for module in (nbsvm, toxicity):
        model = module.fit(df, empty)
        scored, name = module.score(df, model)
        assert [r[name] for r in scored.collect()] == [0.5, 0.5]
        assert module.score(spark.createDataFrame([], EMPTY), model)[0].count() == 0
    one = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    scored, name = nbsvm.score(df, nbsvm.fit(df, one))
    assert {round(r[name], 6) for r in scored.collect()} == {round(2 / 3, 6)}  # one class: the smoothed rate


def test_sample_is_bounded_and_leaves_fold_zero_out(spark, frame):
    rows, labels = corpus(100)
    label = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    sample = features.labelled_sample(frame(rows + rows[:9]), label, "quality", "doc_id", "text", 30).collect()
    assert len(sample) == 30 and all(zlib.crc32(str(r["id"]).encode()) % 5 for r in sample)
