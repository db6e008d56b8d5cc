import math
import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from tests.llm.conftest import EMPTY, words
from threadsift.llm import quality_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_counts(frame, tricky):
    rows = tricky + [(20, "a b c a b c"), (21, "x " * 300), (22, "l\n\nl\n l\nl\x0bm\n#*$%&|<>"), (23, (words(5, 70) + "\n") * 3), (24, "a b c d")]
    df, name = quality_rules.counts(frame(rows))
    got = sorted(((r["doc_id"], *r[name]) for r in df.collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=str)


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for n in (1, 9, 150, 4000) for k in (0, 1, 3, 17, 60) if k <= n for p in (0.005, 0.02, 0.3)]
    df = spark.createDataFrame(cases, "n bigint, k bigint, p double")
    for r in df.withColumn("tail", quality_rules.binomial_tail(F.col("n"), F.col("k"), F.col("p"))).collect():
        n, k, p = r["n"], r["k"], Fraction(r["p"])
        if k >= n * r["p"]:
            assert r["tail"] == 1.0
        else:
            want = float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
            assert math.isclose(r["tail"], want, rel_tol=1e-8, abs_tol=1e-300)


def test_truncated_tail_is_an_upper_bound(spark, monkeypatch):
    df = spark.createDataFrame([(4000, 60)], "n bigint, k bigint")
    tail = quality_rules.binomial_tail(F.col("n"), F.col("k"), F.lit(0.02))
    exact = df.select(tail).first()[0]
    monkeypatch.setattr(quality_rules, "TAIL_TERMS", 10)
    short = df.select(quality_rules.binomial_tail(F.col("n"), F.col("k"), F.lit(0.02))).first()[0]
    assert exact <= short < 3 * exact


def test_cutoffs_bound_false_rejections(spark, frame, tricky):
    rows, labels = [], []
    for i in range(3000):
        bad = i % 10 == 0
        text = words(i, 60)
        if bad:
            text = text.replace(" ", " ## ")
        elif i % 501 == 0:
            text += " #" * 30  # a good text with many signs
        rows.append((i, text, "en" if i % 3 else "xx", "s"))
        labels.append((i, int(not bad)))
    df = frame(rows + [(d, t, None, None) for d, t in tricky if d is None or d > 10_000])
    table = spark.createDataFrame(labels + [(5, 1), (None, 1), (6, None)], "doc_id bigint, quality int")
    judged = quality_rules.judge(df, table, risk=0.05)
    out = {r["doc_id"]: r for r in judged.where("doc_id is not null").collect()}
    good = [out[i] for i, q in labels if q and not out[i]["base_failed"]]
    assert sum(not r["kept"] for r in good) <= 0.05 * len(good)
    english_bad = [out[i] for i, q in labels if not q and i % 3]
    assert not any(r["kept"] for r in english_bad)
    # too few labels in a stratum: nothing beyond the base limits is rejected
    few = quality_rules.judge(df, table.limit(20))
    assert few.where("kept = base_failed").count() == 0


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality_rules.judge(spark.createDataFrame([], EMPTY), none).count() == 0
