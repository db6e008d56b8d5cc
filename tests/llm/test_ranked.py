import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EMPTY, words
from threadsift.llm import ranked


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        scored = []
        for d, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * n_docs) // total if total else 0
            score = sum(weight[t] * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    table = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("extra") for c in ("id", "block", "term", "n")})
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit("extra") for c in ("query", "part", "times")})
    rows = ranked.search(ranked.build_index(table), asked, k=k).collect()
    return sorted(((r["query"]["id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [words(seed, 60), "Ärger", "x1", "42"]
    vocabulary = " ".join(vocabulary).split()
    return [(i, " ".join(r.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=r.randint(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("block, group", [(1 << 14, 256), (17, 2)])
def test_matches_exhaustive_scores(spark, monkeypatch, tricky, block, group):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked, "QUERY_GROUP", group)
    docs = corpus(5, 300) + [(d, t) for d, t in tricky]
    docs += [(2000 - i, docs[7][1]) for i in range(150)]  # a third of the rows are copies, ids falling
    items = [(i, docs[i * 9][1]) for i in range(12)] + [(3, docs[27][1]), (3, "another text x1"), (50, None), (51, ""), (52, "unheard-of"),
                                                        (None, docs[7][1]), (53, docs[7][1] + " " + docs[7][1])]
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_few_documents_and_empty_tables(spark):
    docs = [(1, "a b c"), (2, "a"), (2, "a"), (None, "a")]
    items = [(1, "a b"), (2, "c c c")]
    assert found(spark, docs, items) == brute(docs, items, 10)
    none = spark.createDataFrame([], EMPTY)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert ranked.search(ranked.build_index(none), asked).count() == 0
    index = ranked.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert ranked.search(index, asked.where(F.lit(False))).count() == 0


def test_best_first_leaves_most_documents_out(monkeypatch):
    """Intervals are dropped by their bounds: far fewer documents are scored than hold a term."""
    r = np.random.default_rng(6)
    size = 20_000
    lists = [np.sort(r.choice(size, 4000, replace=False)) for _ in range(6)]
    impacts = [r.integers(1, 1000, 4000) * (1 + 50 * (r.random(4000) < 0.002)) for _ in range(6)]
    table = ranked.Impacts(lists, impacts, size)
    asked = []
    between = ranked.Impacts.between
    monkeypatch.setattr(ranked.Impacts, "between", lambda self, ranks, lo, hi: asked.append(len(lo)) or between(self, ranks, lo, hi))
    best = ranked.best_first(table, [(t, 1) for t in range(6)], ranked.Maxima(-np.arange(size), size), 10)
    scores = np.zeros(size, np.int64)
    for at, impact in zip(lists, impacts):
        scores[at] += impact
    order = np.lexsort((np.arange(size), -scores))[:10]
    assert best == [(-int(scores[p]), int(p), int(p)) for p in order]
    assert sum(asked) / 3 < 0.1 * (scores > 0).sum()
