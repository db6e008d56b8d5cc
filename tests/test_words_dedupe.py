"""Hot words, trends and de-duplication on small fixtures."""

from collections import Counter

from pyspark.sql import functions as F

from threadsift.functions.text import date_prefix, quarter_label
from threadsift.operators import dedupe, trend, words
from threadsift.operators.stopwords import default_stop_words

TEXT_ROWS = [
    ("issues", "2023-01-05 10:00:00", "Error in API: the error is bad. Error again!"),
    ("issues", "2023-03-31 23:59:59", "bug bug error data-set"),
    ("issues", "2023-04-01 00:00:00", "Bug in the build; version 2 and 22 don't work"),
    ("issues", "2024-01-01 00:00:00", "version image file image"),
    ("issues", "bad-date", "error"),
    ("forum", "2023-02-02 00:00:00", "cannot decide; gonna try python python"),
]


def _df(spark):
    df = spark.createDataFrame(TEXT_ROWS, "source string, time string, content string")
    return df.withColumn("period", quarter_label(date_prefix("time")))


def test_top_words_order_and_ties(spark):
    got = words.hot_words(_df(spark), "content", ["source"], 3).orderBy("source", "rank").collect()
    gh = [(r.word, r.freq, r.rank) for r in got if r.source == "issues"]
    assert gh == [("error", 5, 1), ("bug", 3, 2), ("image", 2, 3)]
    q = [(r.word, r.freq) for r in got if r.source == "forum"]
    # 'cannot' splits into two stop words, 'gonna' into 'gon' + 'na'; ties by word
    assert q == [("python", 2), ("decide", 1), ("gon", 1)]


def test_stop_words_digits_letters(spark):
    stop = set(default_stop_words())
    assert {"0", "9", "a", "z", "github", "the"} <= stop
    assert "22" not in stop and "dont" not in stop
    toks = [r.word for r in words.word_tokens(_df(spark), "content").collect()]
    assert "22" in toks and "2" not in toks and "dont" in toks and "dataset" in toks


def test_period_counts_add_up_to_overall(spark):
    ranked = words.hot_words_levels(_df(spark), "content", "source", "period", n=1000)
    rows = ranked.collect()
    overall = {(r.source, r.word): r.freq for r in rows if r.period == "overall"}
    per = Counter()
    for r in rows:
        if r.period != "overall":
            per[(r.source, r.word)] += r.freq
    # the bad date falls in a null period, which is a group of its own
    assert any(r.period is None for r in rows)
    for key, total in overall.items():
        assert per[key] == total


def test_trend_matrix_and_outer_merge(spark):
    counts = words.word_counts(words.word_tokens(_df(spark), "content", ["period"]), ["period"])
    a = trend.word_period_matrix(counts, ["2023-Q1", "2023-Q2"], n=2)
    b = trend.word_period_matrix(counts, ["2024-Q1"], n=1)
    merged = {r.word: r.asDict() for r in trend.merge_matrices(a, b).collect()}
    assert set(merged) == {"error", "bug", "image"}
    assert merged["image"]["y2023_q1"] == 0 and merged["image"]["y2024_q1"] == 2
    assert merged["error"]["y2023_q1"] == 4 and merged["error"]["y2024_q1"] == 0


ISSUES = [
    # id, url, title, body
    (1, "u3", "same title prefix number one here", "short body"),
    (2, "u1", "same title prefix number two here", "another short"),
    (3, "u2", "a different title entirely", "b" * 100),
    (4, "u4", "yet another title", "b" * 100),
    (5, "u5", "last title", "c" * 39 + "X" + "d" * 60),
]


def _issues(spark):
    return spark.createDataFrame(ISSUES, "id long, url string, title string, body string")


def test_prefix_dedupe_keeps_first_by_order(spark):
    out = dedupe.prefix_dedupe(_issues(spark), "title", 1, 22, [F.col("url"), F.col("id")])
    ids = sorted(r.id for r in out.collect())
    assert ids == [2, 3, 4, 5]  # 1 and 2 share 22 characters; url u1 wins


def test_short_bodies_collapse_or_keep(spark):
    order = [F.col("url"), F.col("id")]
    collapsed = dedupe.prefix_dedupe(_issues(spark), "body", 80, 120, order, "id", "collapse")
    kept = dedupe.prefix_dedupe(_issues(spark), "body", 80, 120, order, "id", "keep")
    # Bodies under 80 characters share the empty slice; 3/4 share 'b'*21
    assert sorted(r.id for r in collapsed.collect()) == [2, 3, 5]
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 5]


def test_cascade_is_idempotent(spark):
    slices = [("body", 1, 40), ("body", 40, 80), ("body", 80, 120)]
    order = [F.col("url"), F.col("id")]
    once = dedupe.cascade_dedupe(_issues(spark), slices, order)
    twice = dedupe.cascade_dedupe(once, slices, order)
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in twice.collect())


def test_first_per_key_and_distinct(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 0, "a"), (2, 5, "c"), (2, 5, "c")], "k int, t int, v string")
    first = sorted(tuple(r) for r in dedupe.first_per_key(df, ["k"], [F.col("t")]).collect())
    assert first == [(1, 0, "a"), (2, 5, "c")]
    assert dedupe.distinct_rows(df).count() == 3


def test_hot_word_reports_end_to_end(spark, tmp_path):
    import os

    from threadsift.sources import readers, sinks

    files = {
        "issues": "2023-01-05 10:00:00\terror bug error\n2023-04-02 00:00:00\tbug build\nbad\tcrash error\n",
        "forum": "2006-05-01 00:00:00\tlife work\n2012-01-01 00:00:00\twork team work\n",
        "qa": "2024-03-03 00:00:00\tpython python\n",
    }
    paths = {}
    for name, text in files.items():
        p = tmp_path / f"{name}.tsv"
        p.write_text(text)
        paths[name] = str(p)
    posts, bad = readers.read_timed_text(spark, paths)
    ranked = words.hot_word_reports(posts, "time", "content", "source",
                                    quarter_sources=["issues"], era_sources=["forum"])
    got = {(r.source, r.period, r.word): r.freq for r in ranked.collect()}
    assert got[("issues", "overall", "error")] == 3            # the bad date still counts overall
    assert got[("issues", "2023-Q1", "error")] == 2 and got[("issues", "2023-Q2", "build")] == 1
    assert got[("forum", "2021-2024", "life")] == 1            # 2006 falls in the last era
    assert got[("forum", "2011-2015", "work")] == 2
    assert {p for s, p, w in got if s == "qa"} == {"overall"}  # no period rule: overall only
    assert not any(p is None for _, p, _ in got)
    out = str(tmp_path / "reports")
    sinks.write_hot_word_reports(ranked, out)
    assert sorted(os.listdir(os.path.join(out, "source=issues"))) == ["period=2023-Q1", "period=2023-Q2", "period=overall"]


def test_stop_word_filter_equals_anti_join(spark):
    from threadsift.operators.stopwords import stop_words_frame

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    inset = words.word_counts(words.word_tokens(docs, "text", ["source"]), ["source"])
    raw = words.word_tokens(docs, "text", ["source"], stop_words=[])
    anti = words.word_counts(raw.join(F.broadcast(stop_words_frame(spark)), "word", "left_anti"), ["source"])
    assert inset.exceptAll(anti).count() == 0 and anti.exceptAll(inset).count() == 0
    assert inset.count() > 0
