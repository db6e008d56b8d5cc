"""Sources with quarantine, sinks, cleaners and profiles on FIXTURES rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.functions.predicates import is_missing
from threadsift.operators import classify, clean, profile, words
from threadsift.sources import readers, sinks

NEWS_CSV = (
    'id,title,text,by,score,time,type\n'
    '1,T,"hello, &#39;world&#39;   x",a,5,2024-01-05 01:02:03,Story\n'
    '2,T2,"multi\nline",b,3,2024-1-5 1:2:3,\n'
    '3,Only title,,c,1,2024-01-05,story\n'
    '4,T4,"   ",d,x,junk,comment\n'
    '1,dup,later text,e,9,2024-01-05 01:02:03,story\n'
    '12a,T,text,f,1,2024-01-05 01:02:03,story\n'
    '5,too,few,fields\n'
    '6,a,b,c,d,e,f,g\n'
)


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_csv_arity_quarantine_and_news_clean(spark, tmp_out):
    path = _write(tmp_out, "news.csv", NEWS_CSV)
    good, bad = readers.read_csv_exact(spark, path, schemas.NEWS, multi_line=True)
    assert good.count() == 6 and bad.count() == 2  # cleaned + quarantined = input rows
    cleaned = {r.id: r for r in clean.clean_news(good).collect()}
    assert set(cleaned) == {"1", "2", "12a"}  # empty/blank text dropped (title-only story too)
    assert cleaned["1"].text in ("hello, world x", "later text")
    assert cleaned["2"].time == "2024-01-05T01:02:03" and cleaned["2"].type is None
    assert cleaned["2"].text == "multi line"


def test_news_profile(spark, tmp_out):
    path = _write(tmp_out, "news.csv", NEWS_CSV)
    good, _ = readers.read_csv_exact(spark, path, schemas.NEWS, multi_line=True)
    comp = {r.column: r.ratio for r in profile.completeness(good, list(schemas.NEWS_FIELDS)).collect()}
    assert comp["text"] == pytest.approx(5 / 6) and comp["id"] == 1.0  # whitespace counts as filled
    miss = {r.column: r.missing for r in profile.missing_counts(good, list(schemas.NEWS_FIELDS)).collect()}
    assert miss == {"text": 2, "type": 1}
    cats = {(r.metric, r.category): r.n for r in profile.category_distribution(good, "id", "time", "type").collect()}
    assert cats[("type_id", "non_numeric")] == 1 and cats[("type_time", "invalid_datetime")] == 2


def test_qa_posts_clean_and_counters(spark):
    rows = [
        ("1", "1", "", "2024-01-01", "7", "", "Title <b>x</b>", "<a><b-c>", "Body &lt;i&gt;", "", "", "", ""),
        ("2", "2", "1", "2024-01-01", " null ", "", "-", "", "``` only code ```", "", "", "", ""),
        ("3", "3", "", "2024-01-01", "1", "", "T", "", "B", "", "", "", ""),
        ("4", "1", "", "NULL", "1", "", "T", "", "B", "", "", "", ""),
        ("5", "2", "", "2024-01-01", "", "", "", "", "Answer text!", "", "", "", ""),
    ]
    df = spark.createDataFrame(rows, schemas.QA)
    out = {r.Id: r for r in clean.clean_qa_posts(df).collect()}
    assert set(out) == {"1", "5"}  # type 3 dropped, missing date dropped, text empty dropped
    assert out["1"].text == "title x body" and out["1"].tags == "a b-c" and out["5"].Score == "0"
    missing = {r.column: r.missing for r in profile.missing_counts(df, list(schemas.QA_FIELDS), rule=is_missing).collect()}
    # '' is missing, ' null ' is not (the null-word rule does not trim)
    assert missing["CreationDate"] == 1 and missing["Title"] == 2 and missing["Score"] == 1
    inv = {r.column: r.invalid for r in profile.invalid_type_counts(df, ["Score"]).collect()}
    assert inv == {"Score": 1}
    mean = profile.numeric_summary(df, "Score").first()
    assert mean.n_valid == 3 and mean.avg_value == 3.0


def test_question_clean(spark):
    rows = [(" //unanswered/How-To\tX// ", 1704067207179575), ("", 5), ("/a-b/", -1), (None, 3)]
    df = spark.createDataFrame(rows, "url string, creationTime long")
    out = [tuple(r) for r in clean.clean_question(df).collect()]
    assert out == [("2024-01-01 00:00:07", "how to x")]


def test_issue_clean_sorted_ranges(spark, tmp_out):
    rows = [("10", "t", "Title", "Body 1!"), ("9", "t", "Ünï", None), ("x", "t", "a", "b"), ("200", "t", "a" * 500, "")]
    df = spark.createDataFrame(rows, "id string, created_at string, title string, body string")
    out = clean.clean_issues(df, num_ranges=2)
    got = [tuple(r) for r in out.collect()]
    assert [g[0] for g in got] == ["9", "10", "200"]  # numeric order, bad id left out
    assert got[1][2] == "Title Body   " and len(got[2][2]) == 400 and got[0][3] == "GH Archive"
    sinks.write_sorted_tsv(out, os.path.join(tmp_out, "sorted"), "id", 2)
    lines = []
    for f in sorted(os.listdir(os.path.join(tmp_out, "sorted"))):
        if f.startswith("part-"):
            lines += open(os.path.join(tmp_out, "sorted", f), encoding="utf-8").read().splitlines()
    assert len(lines) == 3


def test_json_quarantine_and_raw_lines(spark, tmp_out):
    lines = [json.dumps({"id": "1", "created_at": "c", "url": "u", "title": "t", "body": "b"}),
             "not json", json.dumps({"id": "2", "title": "t"})]
    path = _write(tmp_out, "issues.json", "\n".join(lines) + "\n")
    good, bad = readers.read_json_lines(spark, path, schemas.ISSUE, required=["id", "body"])
    assert good.count() == 1
    assert sorted(r.error for r in bad.collect()) == ["malformed", "missing_field"]
    raw = readers.read_raw_json_lines(spark, path)
    assert raw.select(F.get_json_object("json", "$.id")).where("1=1").count() == 3


def test_text_lines_positions_and_label_attach(spark, tmp_out):
    texts = _write(tmp_out, "texts.txt", "first\n\n  second  \nthird\n")
    labels = _write(tmp_out, "labels.txt", "technical\nnon-technical\n\ntechnical\n")
    t = readers.read_text_lines_indexed(spark, texts)
    lab = readers.read_text_lines_indexed(spark, labels, "true_label")
    joined = sorted(tuple(r)[1:] for r in classify.attach_by_position(t, lab).collect())
    assert joined == [(0, "first", "technical"), (1, "second", "non-technical"), (2, "third", "technical")]
    short = _write(tmp_out, "short.txt", "technical\n")
    with pytest.raises(Exception, match="on one side only"):
        classify.attach_by_position(t, readers.read_text_lines_indexed(spark, short, "true_label")).collect()
    with pytest.raises(ValueError):
        readers.read_csv_with_text(spark, os.path.join(tmp_out, "x.parquet"))


def test_reports_and_sizes(spark, tmp_out):
    df = spark.createDataFrame([("issues", "error bug error code"), ("forum", "life work life")], "source string, text string")
    ranked = words.hot_words(df.withColumn("period", F.lit("overall")), "text", ["source", "period"], 10)
    out = os.path.join(tmp_out, "reports")
    sinks.write_hot_word_reports(ranked, out)
    folder = os.path.join(out, "source=issues", "period=overall")
    part = [f for f in os.listdir(folder) if f.startswith("part-")]
    text = "".join(open(os.path.join(folder, f), encoding="utf-8").read() for f in part)
    lines = text.splitlines()
    assert lines[0] == "issues hot words overall:"
    assert lines[1:] == ["error: 2", "bug: 1", "code: 1"]  # `word: freq`, by count then word
    assert sinks.output_size_mb(spark, out) > 0


def test_streaming_windowed_counts(spark, tmp_out):
    from threadsift.streaming import streams

    src = os.path.join(tmp_out, "stream_in")
    spark.createDataFrame([("2024-01-01 00:00:00", "error bug error"), ("2024-01-09 00:00:00", "bug")],
                          "ts string, text string").select(F.col("ts").cast("timestamp"), "text") \
        .write.parquet(src)
    schema = "ts timestamp, text string"
    stream = spark.readStream.schema(schema).parquet(src)
    counts = streams.windowed_word_counts(stream, "text", "ts", window="7 days", delay="1 day")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("wc_test") \
        .option("checkpointLocation", os.path.join(tmp_out, "ckpt")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.word, r.freq) for r in spark.sql("select word, freq from wc_test").collect()}
    assert ("error", 2) in got and ("bug", 1) in got


def test_timed_text_per_source(spark, tmp_out):
    a = _write(tmp_out, "issues_text.txt", "2023-01-05 10:00:00\terror here\n2023-02-01\tmore\tcolumns\n")
    b = _write(tmp_out, "forum_text.txt", "2021-03-03 00:00:00\tlife\n")
    good, bad = readers.read_timed_text(spark, {"issues": a, "forum": b})
    rows = sorted((r.source, r.time, r.content) for r in good.collect())
    assert rows == [("forum", "2021-03-03 00:00:00", "life"), ("issues", "2023-01-05 10:00:00", "error here")]
    assert bad.count() == 1


def test_error_samples_are_bounded(spark):
    bad = spark.createDataFrame([(f"line {i}", "malformed" if i % 3 else "missing_field") for i in range(50)],
                                "raw string, error string")
    got = {r.error: r for r in profile.error_samples(bad, n=5).collect()}
    assert got["malformed"].n == 33 and len(got["malformed"].examples) == 5
    assert got["missing_field"].n == 17 and len(got["missing_field"].examples) == 5


def test_positions_over_several_files(spark, tmp_out):
    # three files a side, of other sizes and so packed and read in other orders
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sizes = (5, 30, 20)
    for side, width in (("texts", 40), ("labels", 3)):
        os.makedirs(os.path.join(tmp_out, side))
        for f, n in enumerate(sizes):
            pad = "x" * (width if f != 1 else 200 - width)
            _write(os.path.join(tmp_out, side), f"part-{f}.txt", "".join(f"{f}-{i} {pad}\n\n" for i in range(n)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        a = readers.read_text_lines_indexed(spark, os.path.join(tmp_out, "texts"))
        b = readers.read_text_lines_indexed(spark, os.path.join(tmp_out, "labels"), "true_label")
        rows = classify.attach_by_position(a, b).collect()
        assert len(rows) == sum(sizes)
        assert all(r.text.split()[0] == r.true_label.split()[0] == f"{r.file}-{r.pos}" for r in rows)
        os.remove(os.path.join(tmp_out, "labels", "part-2.txt"))
        fewer = readers.read_text_lines_indexed(spark, os.path.join(tmp_out, "labels"), "true_label")
        with pytest.raises(Exception, match="on one side only"):
            classify.attach_by_position(a, fewer).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tsv_round_trip_and_splitting(spark, tmp_out):
    values = ['"starts with a quote', 'a "b" c"', "tab\there", "line\nbreak", "back\\slash \\t", "\\\\n", "plain", "cr\rend"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "time string, content string")
    path = os.path.join(tmp_out, "out")
    sinks.write_tsv(df, path)
    good, bad = readers.read_timed_text(spark, {"x": path})
    assert bad.count() == 0 and [r.content for r in good.orderBy(F.col("time").cast("int")).collect()] == values
    big = _write(tmp_out, "big.csv", "id,title,text,by,score,time,type\n" + "".join(f"{i},t,x y,b,1,t,story\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        good, bad = readers.read_csv_exact(spark, big, schemas.NEWS)
        assert good.rdd.getNumPartitions() > 3 and good.count() == 20_000 and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_values_of_the_cleaners(spark):
    from threadsift.functions import text as T

    one = lambda c, v: spark.createDataFrame([(v,)], "v string").select(c("v")).first()[0]
    assert one(T.keep_word_punct, "\u0939\u093f x\u00b2 \u00bd _!") == "\u0939  x\u00b2 \u00bd _!"
    assert one(T.try_int, "3000000000") == 3_000_000_000 and one(T.try_int, " \u0663_\u0664 ") == 34
    assert one(T.try_int, "9" * 30) is None and one(T.is_int, "9" * 30) and one(T.is_int, "1.0") is False
    assert [one(T.is_valid_datetime, s) for s in ("2024-1-5 1:2:3", "24-1-5 1:2:3", "02024-01-05 01:02:03")] == [True, False, False]
    assert one(T.to_iso_datetime, "2024-1-5 1:2:3") == "2024-01-05T01:02:03"


def test_empty_posts_are_counted(spark):
    rows = [("1", "1", "", "2024-01-01", "7", "", "<b></b>", "", "<p> </p>", "", "", "", ""),
            ("2", "2", "", "2024-01-01", "7", "", "-", "", "kept", "", "", "", "")]
    posts = clean.clean_qa_posts(spark.createDataFrame(rows, schemas.QA), keep_empty=True)
    found = {r.metric: r.value for r in profile.counters(posts, {
        "total_posts": F.lit(1), "empty_text": F.trim("text") == ""}).collect()}
    assert found == {"total_posts": 2, "empty_text": 1}


def test_small_sources(spark, tmp_out):
    assert readers.read_labelled(spark, [("t", 1)]).count() == 1
    spark.range(3).write.parquet(os.path.join(tmp_out, "corpus"))
    corpus = readers.read_corpus(spark, os.path.join(tmp_out, "corpus"), ["id"])
    readers.register_table(corpus, "corpus_table")
    assert spark.sql("SELECT count(*) FROM corpus_table").first()[0] == 3


def test_dropped_rows_are_counted_by_the_write(spark, tmp_out):
    """One pass: the counts come from the action that writes, and rows are those of the plain cleaner."""
    row = lambda **k: tuple({"Id": "1", "PostTypeId": "1", "CreationDate": "2024-01-01", "Title": "t", "Tags": "<a>"}.get(f, "")
                            if f not in k else k[f] for f in schemas.QA_FIELDS)
    rows = [row(), row(Id="2", PostTypeId="2", Tags=""), row(PostTypeId="3"), row(PostTypeId=None, Id=None), row(Id=" - "),
            row(CreationDate="null", Title=""), row(Title="<b></b>"), row(Id=None)]
    posts = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in schemas.QA_FIELDS))
    counts = clean.DropCounts()
    cleaned = clean.clean_qa_posts(posts, counts=counts)
    assert cleaned.columns == clean.clean_qa_posts(posts).columns
    sinks.write_tsv(cleaned, tmp_out + "/qa")
    assert counts.values == {"rows": 8, "kept": 2, "other_type": 2, "missing_id": 2, "missing_date": 1, "empty_text": 1,
                             "questions": 2, "answers": 1, "posts_with_tags": 2}
    assert spark.read.text(tmp_out + "/qa").count() == 2 == clean.clean_qa_posts(posts).count()

    news = spark.createDataFrame([("1", "a", "x"), ("1", "b", "y"), ("", "c", "z"), ("2", "d", "&#39; ")], "id string, title string, text string")
    news = news.withColumns({c: F.lit(None).cast("string") for c in ("by", "score", "time", "type")})
    counts = clean.DropCounts()
    assert len(clean.clean_news(news, counts=counts).collect()) == 1
    assert counts.values == {"rows": 4, "kept": 1, "missing_id": 1, "empty_text": 1, "duplicate": 1}

    issues = spark.createDataFrame([("10", "t", "a", "b"), ("x", "t", "a", "b"), (None, "t", "a", "b"), ("9", "t", "a", "b")] * 50,
                                   "id string, created_at string, title string, body string")
    counts = clean.DropCounts()
    assert [r.id for r in clean.clean_issues(issues, counts=counts).collect()] == ["9"] * 50 + ["10"] * 50
    assert counts.values == {"rows": 200, "kept": 100, "bad_id": 100}
