"""Classifier reports, exact quantiles/AUC, folds and sampling."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from threadsift.operators import classify, quantiles, sample

SF = "/root/testdata/sf0.01"


def _scored(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lab = "technical" if rng.random() < 0.6 else "non-technical"
        conf = round(rng.uniform(0.5, 1.0), 3) if i % 7 else 0.9  # many ties and exact 0.9
        rows.append((i, lab, conf))
    return spark.createDataFrame(rows, "id long, predicted_label string, confidence double"), rows


def test_softmax_argmax(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 3.0],), ([1000.0, -1000.0],)], "l array<double>")
    out = classify.scores_from_logits(df, F.col("l")).collect()
    assert [r.predicted for r in out] == [1, 0, 0]
    assert math.isclose(out[0].confidence, math.exp(2) / (math.exp(1) + math.exp(2)))
    assert out[1].confidence == 0.5 and out[2].confidence == 1.0
    assert [r.predicted_label for r in out] == ["non-technical", "technical", "technical"]


def test_report_share_high_confidence(spark):
    df, rows = _scored(spark)
    rep = {r.predicted_label: r for r in classify.prediction_report(df).collect()}
    n_tech = sum(1 for r in rows if r[1] == "technical")
    assert rep["technical"].n == n_tech
    assert math.isclose(rep["technical"].pct, n_tech * 100 / len(rows))
    hi = classify.high_confidence(df).first()
    assert hi.n_high == sum(1 for r in rows if r[2] > 0.9)  # exactly 0.9 is not high
    empty = classify.high_confidence(df.where("false")).first()
    assert empty.n == 0 and empty.pct_high is None


def test_boxplot_matches_numpy(spark):
    df, rows = _scored(spark)
    got = {r.predicted_label: r for r in classify.confidence_boxplot(df).collect()}
    for lab in ("technical", "non-technical"):
        v = np.array([r[2] for r in rows if r[1] == lab])
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        iqr = q3 - q1
        assert math.isclose(got[lab].q1, q1) and math.isclose(got[lab].median, med) and math.isclose(got[lab].q3, q3)
        assert got[lab].whisker_low == v[v >= q1 - 1.5 * iqr].min()
        assert got[lab].whisker_high == v[v <= q3 + 1.5 * iqr].max()


def test_auc_matches_pairwise_count(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 20), 1 if rng.random() < 0.4 else 0) for _ in range(300)]
    df = spark.createDataFrame(rows, "score int, label int").withColumn("pred", (F.col("score") > 10).cast("int"))
    m = classify.binary_metrics(df, "label", "pred", "score").first()
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert math.isclose(m.roc_auc, wins / (len(pos) * len(neg)))
    tp = sum(1 for s, y in rows if y == 1 and s > 10)
    fp = sum(1 for s, y in rows if y == 0 and s > 10)
    assert math.isclose(m.precision, tp / (tp + fp))


def test_stratified_folds_are_balanced(spark):
    df = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(1000)], "id long, label int")
    folds = sample.stratified_folds(df, "label", "id", 5)
    counts = folds.groupBy("label", "fold").count().collect()
    by_label = {}
    for r in counts:
        by_label.setdefault(r.label, []).append(r["count"])
    for sizes in by_label.values():
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert folds.count() == 1000


def test_rank_within_matches_row_number(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double")
    ranked = sample.rank_within(df, ["k"], F.col("v"), F.floor(F.col("v") * 64), "r").collect()
    for key in "ab":
        vals = sorted(r.v for r in ranked if r.k == key)
        assert [r.v for r in sorted((r for r in ranked if r.k == key), key=lambda r: r.r)] == vals


def test_samples(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "n_chars")
    assert sample.random_sample(docs, 10).count() == 10
    assert sample.hash_sample(docs, 7, "doc_id").count() == 7
    total = docs.agg(F.sum("n_chars")).first()[0]
    assert sample.size_target_sample(docs, F.col("n_chars"), total * 2, "doc_id").count() == docs.count()
    half = sample.size_target_sample(docs, F.col("n_chars"), total // 2, "doc_id").count()
    assert half == int(docs.count() * ((total // 2) / total))


def test_augment_replaces_up_to_n_words(spark):
    df = spark.createDataFrame([(1, "the cat and the dog and it"), (2, "nothing here")], "id long, text string")
    out = classify.augment_synonyms(df, "text", "id", {"the": "a", "and": "plus", "it": "information_technology"}, n=2)
    rows = {(r.id, r.augmented): r.text for r in out.collect()}
    assert rows[(1, False)] == "the cat and the dog and it"
    changed = [w for w, o in zip(rows[(1, True)].split(" "), "the cat and the dog and it".split(" ")) if w != o]
    assert 0 < len(set(changed)) <= 2
    assert rows[(2, True)] == "nothing here"


def test_train_and_score_beats_chance(spark):
    from threadsift.plans.registry import QUERIES, load_all

    load_all()
    scored = QUERIES["train_score"](spark, SF)
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    scored = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    m = classify.binary_metrics(scored.withColumn("score", F.when(F.col("predicted") == 1, F.col("confidence"))
                                                  .otherwise(1 - F.col("confidence"))),
                                "quality", "predicted", "score").first()
    assert m.roc_auc > 0.5


def _length_model():
    import numpy as np

    def predict(texts):
        lengths = np.array([len(t) for t in texts], dtype=float)
        return np.stack([40.0 - lengths, lengths - 40.0], axis=1) / 10.0

    return predict


def test_batch_scorer_with_user_model(spark):
    df = spark.createDataFrame([("short",), ("x" * 100,)], "text string")
    score = classify.batch_scorer(_length_model, batch_size=8)
    out = classify.scores_from_logits(df.withColumn("logits", score("text")), F.col("logits"), keep=["text"])
    got = {r.text[:5]: (r.predicted_label, round(r.confidence, 3)) for r in out.collect()}
    assert got["short"][0] == "technical" and got["xxxxx"][0] == "non-technical"
    assert got["xxxxx"][1] == round(1 / (1 + math.exp(-12)), 3)


def test_logistic_option_trains(spark):
    rows = [(f"python code error {i}", 0, i % 2) for i in range(6)] + [(f"career team advice {i}", 1, i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, "text string, label int, fold int")
    model = classify.train_text_classifier(df, "text", "label", "fold", num_folds=2, parallelism=1, model="logistic")
    scored = classify.score_texts(model, df, keep=["label"]).collect()
    assert sum(r.predicted == r.label for r in scored) >= 10


def test_hash_sample_is_one_method_for_every_size(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    ids = sorted((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id) for r in docs.collect())
    for n in (0, 1, 300, len(ids), len(ids) + 5):
        found = sample.hash_sample(docs, n, "doc_id")
        assert "TakeOrderedAndProject" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in found.collect()) == sorted(i for _, i in ids[:n])


def test_random_sample_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    taken = lambda df, seed: sorted(r.doc_id for r in sample.random_sample(df, 100, seed).collect())
    first = taken(docs, 1)
    assert len(first) == 100 and first == taken(docs.repartition(7), 1) and first != taken(docs, 2)


def test_first_synonym_counts(spark):
    rows = [("a", "z"), ("a", "m"), ("a", "b_c")]
    df = spark.createDataFrame([(1, "a a x")], "id int, text string")
    for part in (1, 2, 5):
        syn = spark.createDataFrame(rows, "word string, synonym string").repartition(part)
        assert [r.text for r in classify.augment_synonyms_table(df, "text", "id", syn).where("augmented").collect()] == ["b c b c x"]


def test_balanced_buckets_stay_exact_on_clustered_values(spark):
    rng = random.Random(21)
    # most values crowded into a tiny range, a few far away
    vals = [0.5 + rng.random() * 1e-6 for _ in range(400)] + [rng.random() * 1000 for _ in range(20)]
    labels = [1 if rng.random() < 0.5 else 0 for _ in vals]
    df = spark.createDataFrame(list(zip(vals, labels)), "v double, y int")
    buckets = quantiles.with_bucket(df, "v", "b", 64).groupBy("b").count()
    assert buckets.agg(F.max("count")).first()[0] <= 30  # crowded values spread over the buckets
    q = quantiles.exact_quantiles(df, "v", (0.25, 0.5, 0.9)).first()
    for p, name in ((0.25, "q25"), (0.5, "q50"), (0.9, "q90")):
        assert math.isclose(q[name], float(np.percentile(vals, p * 100)))
    auc = quantiles.roc_auc(df, "v", "y").first()[0]
    pos = [v for v, y in zip(vals, labels) if y == 1]
    neg = [v for v, y in zip(vals, labels) if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert math.isclose(auc, wins / (len(pos) * len(neg)))


def test_cross_validate_augmented_keeps_validation_clean(spark):
    rows = [(i, f"python code error stack trace {i}", 0, i % 3) for i in range(12)] + \
           [(100 + i, f"career team advice salary {i}", 1, i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, text string, label int, fold int")
    model, aucs = classify.cross_validate_augmented(df, "text", "label", "fold", "id",
                                                    {"code": "program", "team": "group"}, k=3)
    assert len(aucs) == 3 and all(a > 0.5 for a in aucs)
    assert model is not None


def test_fraction_sample_and_full_shuffle(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    part = sample.fraction_sample(df, 0.25, seed=7)
    n = part.count()
    assert 350 < n < 650 and part.count() == n  # seeded: the same rows each time
    shuffled = sample.full_shuffle(df, seed=42)
    ids = [r.doc_id for r in shuffled.collect()]
    assert sorted(ids) == list(range(2000)) and ids != list(range(2000))  # every row once, reordered
    assert ids == [r.doc_id for r in sample.full_shuffle(df, seed=42).collect()]


def _synonym_rows(spark, hot=0):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i % 40, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for i in range(200)]
    rows += [(3, "w1 w2 w3"), (3, "W1 w2 w3"), (3, "w1 w2 w3"), (None, "w4 w5 w6 w7"), (None, None), (5, None), (6, ""), (7, " \t ")]
    rows += [(1000 + i, f"w0 filler{i}") for i in range(hot)]
    return spark.createDataFrame(rows, "id long, text string"), {w: w.upper() + "_x" for w in vocabulary[::2]}


def test_synonym_table_equals_the_map_form(spark):
    df, synonyms = _synonym_rows(spark)
    table = spark.createDataFrame(list(synonyms.items()), "word string, synonym string")
    want = classify.augment_synonyms(df, "text", "id", synonyms, n=2, salt="s")
    got = classify.augment_synonyms_table(df, "text", "id", table, n=2, salt="s")
    order = lambda d: sorted(map(str, d.collect()))
    assert order(got) == order(want)
    shared = {r.text for r in got.where("id = 3 and augmented").collect()}
    assert {"w1 W2 x w3", "W1 W2 x w3"} <= shared  # texts that share an id keep their own words


def test_a_word_of_every_text_is_split(spark):
    """Neither side of the joins is bound to the exchange of an aggregate: hot keys are split at run time."""
    df, synonyms = _synonym_rows(spark, hot=30_000)
    table = spark.createDataFrame(list(synonyms.items()), "word string, synonym string")
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "64"}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        out = classify.augment_synonyms_table(df.repartition(20), "text", "id", table, n=2)
        assert out.where("augmented and text like 'W0 x filler%'").count() == 30_000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k in low:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "skew=true" in plan
    words = [line for line in plan.splitlines() if "hashpartitioning(word" in line]
    assert words and any("_part" in line for line in words)


def test_fold_models_equal_separate_fits(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF
    from pyspark.ml.functions import vector_to_array

    from threadsift.operators import folds

    rng = random.Random(4)
    words = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(240):
        y = int(rng.random() < 0.4)
        rows.append((i, " ".join(rng.choices(words, [1 + (j % 3 == y) for j in range(60)], k=rng.randint(0, 25))), y, i % 4))
    df = spark.createDataFrame(rows, "id long, text string, label int, fold int")
    found = folds.cross_validate(df, "text", "label", "fold", 4, smoothing=(0.5, 2.0), num_features=1 << 10)
    data = df.withColumn("label", F.col("label").cast("double"))
    for s in (0.5, 2.0):
        for fold in range(4):
            stages = [*folds.text_stages("text", 1 << 10), IDF(inputCol="_tf", outputCol="features"),
                      NaiveBayes(featuresCol="features", labelCol="label", smoothing=s)]
            model = Pipeline(stages=stages).fit(data.where(F.col("fold") != fold))
            raw = vector_to_array("rawPrediction")
            held = model.transform(data.where(F.col("fold") == fold)).select("id", "label", (raw[1] - raw[0]).alias("m"))
            assert math.isclose(found.aucs[s][fold], quantiles.roc_auc(held, "m", "label").first()[0], rel_tol=1e-9)
            if s == found.smoothing:
                mine, theirs = found.folds[fold].stages[-1], model.stages[-1]
                assert np.allclose(mine.theta.toArray(), theirs.theta.toArray()) and np.allclose(mine.pi.toArray(), theirs.pi.toArray())
    full = Pipeline(stages=[*folds.text_stages("text", 1 << 10), IDF(inputCol="_tf", outputCol="features"),
                            NaiveBayes(featuresCol="features", labelCol="label", smoothing=found.smoothing)]).fit(data)
    assert np.allclose(found.final.stages[-1].theta.toArray(), full.stages[-1].theta.toArray())
    assert found.smoothing == max((0.5, 2.0), key=lambda s: np.mean(found.aucs[s]))


def test_copies_train_but_are_not_scored(spark):
    from threadsift.operators import folds

    rows = [(i, f"a b w{i % 5}" if i % 2 else f"c d w{i % 5}", i % 2, i // 2 % 3, False) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label int, fold int, copy boolean")
    more = df.withColumns({"text": F.concat(F.col("text"), F.lit(" z")), "copy": F.lit(True)})
    found = folds.cross_validate(df.union(more), "text", "label", "fold", 3, num_features=64, training_only="copy")
    alone = folds.cross_validate(df, "text", "label", "fold", 3, num_features=64)
    assert found.aucs == alone.aucs == {1.0: [1.0, 1.0, 1.0]}
    assert found.final.stages[-1].theta != alone.final.stages[-1].theta


def test_large_integers_stay_exact(spark):
    big = 9007199254740993  # 2 ** 53 + 1
    rows = [(big + i, i % 2) for i in range(7)]
    df = spark.createDataFrame(rows, "v bigint, y int")
    q = quantiles.exact_quantiles(df, "v", (0, 0.5, 1)).first()
    assert (q["q0"], q["q100"]) == (big, big + 6) and q["q50"] == float(big + 3)
    pos, neg = [v for v, y in rows if y], [v for v, y in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert quantiles.roc_auc(df, "v", "y").first()[0] == auc
    box = classify.confidence_boxplot(df.select(F.lit("a").alias("predicted_label"), F.col("v").alias("confidence"))).first()
    assert (box.whisker_low, box.whisker_high) == (big, big + 6)


def test_quantiles_sort_only_the_buckets_wanted(spark):
    rng = random.Random(8)
    vals = [(k, rng.random() if k else float(rng.randint(0, 3))) for k in (0, 1) for _ in range(5000)]
    df = spark.createDataFrame(vals, "k int, v double")
    probs = (0, 0.1, 0.25, 0.5, 0.9, 0.999, 1)
    out = quantiles.exact_quantiles(df, "v", probs, ["k"])
    for r in out.collect():
        want = np.percentile([v for k, v in vals if k == r["k"]], [p * 100 for p in probs])
        assert np.allclose(list(r)[1:], want, rtol=1e-12)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 8
    assert set(quantiles.exact_quantiles(df.where("false"), "v", probs).first()) == {None}
