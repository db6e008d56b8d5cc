"""Remaining sources/sinks round trips and stream operators."""

import json
import os

from pyspark.sql import functions as F

from threadsift.functions import text as T
from threadsift.operators import classify
from threadsift.sources import readers, sinks
from threadsift.streaming import streams


def test_day_sharded_scan_prunes_partitions(spark, tmp_out):
    path = os.path.join(tmp_out, "events")
    rows = [(i, f"{d:04d}", "IssuesEvent") for i, d in enumerate([101, 105, 1031, 1101, 1231])]
    spark.createDataFrame(rows, "id int, day string, type string").write.partitionBy("day").parquet(path)
    df = readers.read_day_sharded(spark, path, "0101", "1031")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_csv_json_partitioned_and_tsv_sinks(spark, tmp_out):
    df = spark.createDataFrame([(1, "story", "a, \"b\""), (2, "comment", "c\nd")], "id int, type string, text string")
    sinks.write_csv(df, os.path.join(tmp_out, "csv"), partition_by=["type"])
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(os.path.join(tmp_out, "csv"))
    assert sorted((r.type, r.text) for r in back.collect()) == [("comment", "c\nd"), ("story", 'a, "b"')]
    sinks.write_json(df, os.path.join(tmp_out, "json"))
    assert spark.read.json(os.path.join(tmp_out, "json")).count() == 2
    sinks.write_tsv(df.where("id = 1"), os.path.join(tmp_out, "tsv"))
    lines = [line for f in os.listdir(os.path.join(tmp_out, "tsv")) if f.startswith("part-")
             for line in open(os.path.join(tmp_out, "tsv", f), encoding="utf-8").read().splitlines()]
    assert lines == ['1\tstory\ta, "b"']


def test_prediction_report_file(spark, tmp_out):
    scored = spark.createDataFrame([("x", "technical", 0.95), ("y", "non-technical", 0.6), ("z", "technical", 0.9)],
                                   "text string, predicted_label string, confidence double")
    rep = classify.prediction_report(scored)
    lines = classify.report_lines(rep, classify.high_confidence(scored), "2026-01-01 00:00:00")
    out = os.path.join(tmp_out, "report")
    sinks.write_report(lines, out)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 1
    text = open(os.path.join(out, files[0]), encoding="utf-8").read()
    assert text.startswith("=== Text Classification Analysis Report ===")
    assert "Analysis Date: 2026-01-01 00:00:00" in text
    assert text.splitlines()[4:] == [
        "1. Overall Statistics:", "Total samples analyzed: 3", "",
        "2. Technical Content:", "Count: 2", "Percentage: 66.7%", "Average confidence: 0.925", "",
        "3. Non-Technical Content:", "Count: 1", "Percentage: 33.3%", "Average confidence: 0.600", "",
        "4. High Confidence Predictions:", "Number of predictions with >90% confidence: 1",
        "Percentage of high confidence predictions: 33.3%"]
    only = classify.prediction_report(scored.where("predicted_label = 'technical'"))
    lines = [r.line for r in classify.report_lines(only, classify.high_confidence(scored), "x").orderBy("i").collect()]
    assert lines[12:16] == ["3. Non-Technical Content:", "Count: 0", "Percentage: 0.0%", "Average confidence: 0.000"]


def test_model_save_and_reload(spark, tmp_out):
    from pyspark.ml import PipelineModel

    rows = [(f"python code error {i}", 0, i % 2) for i in range(6)] + [(f"career team advice {i}", 1, i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, "text string, label int, fold int")
    model = classify.train_text_classifier(df, "text", "label", "fold", num_folds=2, parallelism=1)
    sinks.save_model(model, os.path.join(tmp_out, "model"))
    loaded = PipelineModel.load(os.path.join(tmp_out, "model"))
    scored = classify.score_texts(loaded, df, keep=["label"]).collect()
    assert sum(r.predicted == r.label for r in scored) >= 10


def test_clean_and_dedupe_streams(spark, tmp_out):
    src = os.path.join(tmp_out, "in")
    rows = [("1", "2024-01-01 00:00:00", "Hello &#39;x&#39;   there"), ("1", "2024-01-01 00:10:00", "again"),
            ("2", "2024-01-01 00:20:00", "Other")]
    spark.createDataFrame(rows, "id string, ts string, text string") \
        .select("id", F.col("ts").cast("timestamp").alias("ts"), "text").write.parquet(src)
    stream = streams.read_stream(spark, src, spark.read.parquet(src).schema)
    cleaned = streams.clean_stream(stream, {"id": F.col("id"), "ts": F.col("ts"),
                                            "text": T.strip_numeric_entities("text")})
    deduped = streams.dedupe_stream(cleaned, ["id"], "ts", "1 hour")
    q = deduped.writeStream.format("memory").queryName("dedupe_test").outputMode("append") \
        .option("checkpointLocation", os.path.join(tmp_out, "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.id, r.text) for r in spark.sql("select id, text from dedupe_test").collect())
    assert [g[0] for g in got] == ["1", "2"]
    assert ("2", "Other") in got


def test_question_records_roundtrip_json(spark, tmp_out):
    q = {"qid": "1", "url": "/x/", "title": None, "creationTime": 1, "followerCount": 0, "viewCount": 0,
         "numAnswers": 0, "numMachineAnswers": 0, "isLocked": False, "isTrendyQuestion": False,
         "asker": "a", "answers": "[]"}
    path = os.path.join(tmp_out, "q.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(q) + "\n")
    raw = readers.read_raw_json_lines(spark, path)
    from threadsift.operators.questions import question_profile

    got = {r.metric: r.value for r in question_profile(raw).collect()}
    assert got["Question Null Title"] == 1 and got["Answer Number Not Match"] == 1
