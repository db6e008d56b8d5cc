import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EMPTY, words
from threadsift.llm import mixing

WEIGHTS = ({"a": 0.7, "b": 0.3}, {"en": 2.0, "de": 1.0, "xx": 0.0}, None)


def fill(budget, weight, capacity):
    out, active = dict.fromkeys(weight, 0.0), {k for k in weight if weight[k] > 0 and capacity[k] > 0}
    while active:
        level = budget / sum(weight[k] for k in active)
        full = {k for k in active if capacity[k] <= level * weight[k]}
        if not full:
            return out | {k: level * weight[k] for k in active}
        for k in full:
            out[k] = capacity[k]
            budget -= capacity[k]
        active -= full
    return out


def budgets(leaves, total, epochs):
    capacity = {k: 0 if any((w or {}).get(n, 1.0) <= 0 for n, w in zip(k, WEIGHTS)) else v * epochs for k, v in leaves.items()}
    level = {(): total}
    for depth in range(3):
        below = {}
        for node, budget in level.items():
            children = {k[:depth + 1] for k in leaves if k[:depth] == node}
            below |= fill(budget, {c: (WEIGHTS[depth] or {}).get(c[-1], 1.0) for c in children},
                          {c: sum(v for k, v in capacity.items() if k[:depth + 1] == c) for c in children})
        level = below
    return level


def path():
    return [F.when(F.col("source").isin("s1", "s2", "s3"), "a").otherwise("b"), F.col("lang"), F.col("source")]


@pytest.mark.parametrize("fraction,epochs", [(0.4, 3), (1.3, 2), (9.0, 2), (0.0, 2)])
def test_budgets_and_prefixes(frame, tricky, fraction, epochs):
    r = random.Random(8)
    rows = [(100 + i, words(i, r.randint(1, 60)), r.choice(["en", "de", "fr", "xx"]), f"s{min(r.randint(1, 9), r.randint(1, 9))}") for i in range(900)]
    rows += [(d, t, None, "s1") for d, t in tricky[:9]]
    df = frame(rows)
    taken, names = mixing.mix(df, path(), WEIGHTS, fraction, epochs)
    assert taken.columns == [*df.columns, *(names[n] for n in ("epoch", "tokens", "taken"))]
    out = [(x["doc_id"], x["lang"] or "", x["source"], x[names["epoch"]], x[names["tokens"]], x[names["taken"]], x["text"]) for x in taken.collect()]
    assert taken.where("n_chars <> length(text)").count() == 0
    leaves = defaultdict(int)
    size = {}
    for d, t, lang, source in rows:
        n = len((t or "").split())
        if n:
            leaves["a" if source in ("s1", "s2", "s3") else "b", lang or "", source] += n
            size[d] = n
    want = budgets(leaves, sum(leaves.values()) * fraction, epochs)
    got, cuts = defaultdict(int), defaultdict(int)
    by_epoch = defaultdict(set)
    for d, lang, source, epoch, tokens, n, text in out:
        leaf = ("a" if source in ("s1", "s2", "s3") else "b", lang, source)
        got[leaf] += n
        assert tokens == size[d] and 0 < n <= tokens and len(text.split()) == n and epoch < epochs
        cuts[leaf] += n < tokens
        by_epoch[leaf, epoch].add(d)
    assert {k: int(v + 1e-6) for k, v in want.items() if int(v + 1e-6)} == dict(got)
    assert max(cuts.values(), default=0) <= 1
    everything = defaultdict(set)
    for d, t, lang, source in rows:
        if d in size:
            everything["a" if source in ("s1", "s2", "s3") else "b", lang or "", source].add(d)
    for (leaf, epoch), ids in by_epoch.items():  # earlier epochs are whole
        assert ids == everything[leaf] or (leaf, epoch + 1) not in by_epoch


def test_seed_and_layout(frame):
    rows = [(i, words(i, 20), "en", "s1") for i in range(300)]
    chosen = lambda df, seed: {r["doc_id"] for r in mixing.mix(df, path(), WEIGHTS, 0.3, 1, seed)[0].collect()}
    first = chosen(frame(rows), 1)
    assert first == chosen(frame(rows[::-1]).repartition(7), 1) != chosen(frame(rows), 2)


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], EMPTY), path(), WEIGHTS, 0.5)[0].count() == 0
