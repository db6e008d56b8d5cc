"""Question/answer profile queries on ``conversations``.

Every conversation turn becomes one question record in the source's NDJSON
shape: its lines are the answers, the comma-separated clauses of a line are
the comments of that answer, and the long words of a clause are comments
on the comment (three levels). Fields are derived from the text and the
turn, with some keys removed or added, so every counter sees both outcomes.
The SQL oracle computes the same counters straight from the text, without
going through JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators import questions
from threadsift.plans.registry import register
from threadsift.plans.tables import table

LONG_WORD = 9


def _answer_json(line: Column, i: Column, qid: Column, role: Column, conv_id: Column) -> Column:
    clauses = F.split(line, ", ")
    comments = F.transform(clauses, lambda c: F.struct(
        c.alias("content"),
        F.transform(F.filter(F.split(c, " "), lambda w: F.length(w) > LONG_WORD),
                    lambda w: F.struct(w.alias("content"), F.array().cast("array<string>").alias("comments"))
                    ).alias("comments")))
    fields = [
        F.concat(qid, F.lit("-"), i.cast("string")).alias("aid"),
        F.concat(F.lit("/answer/"), i.cast("string")).alias("url"),
        line.alias("content"), role.alias("author"),
        line.rlike("[0-9]").alias("isSensitive"), (F.length(line) < 60).alias("isShortContent"),
        (conv_id * 1000 + i).alias("creationTime"), (F.length(line) - 30).alias("numViews"),
        (i - 1).alias("numUpvotes"), (F.size(F.split(line, " ")) - 5).alias("numShares"),
        F.size(clauses).alias("numComments"), comments.alias("comments"),
    ]
    normal = F.to_json(F.struct(*fields))
    extra = F.to_json(F.struct(*fields, F.lit(1).alias("extra")))
    return F.when(i == 2, extra).otherwise(normal)


def question_records(conv: DataFrame) -> DataFrame:
    """conversations -> ``qid, json`` question records (one per row, no grouping)."""
    turn, conv_id, role, text = F.col("turn"), F.col("conv_id"), F.col("role"), F.col("text")
    lines = F.split(text, "\n")
    qid = F.concat(conv_id.cast("string"), F.lit("-"), turn.cast("string"))
    answers = F.transform(lines, lambda line, i: _answer_json(line, i, qid, role, conv_id))
    answers_text = F.when(turn == 4, F.lit("[]")).otherwise(F.concat(F.lit("["), F.array_join(answers, ","), F.lit("]")))
    n_lines = F.size(lines)
    first_line = F.substring_index(text, "\n", 1)
    slug = F.regexp_replace(F.substring(first_line, 1, 30), "[^A-Za-z]+", "-")
    url = (F.when(role == "system", F.lit(""))
           .when((turn == 4) & (conv_id % 2 == 0), F.concat(F.lit("/unanswered/"), slug, F.lit("/")))
           .otherwise(F.concat(F.lit("/"), slug, F.lit("/"))))
    fields = [
        qid.alias("qid"), url.alias("url"),
        F.when(turn == 1, F.lit(None).cast("string")).otherwise(first_line).alias("title"),
        F.when(turn == 7, F.lit(-1).cast("bigint")).otherwise(conv_id * 1_000_000 + turn).alias("creationTime"),
        (F.length(text) % 50 - 3).alias("followerCount"), (F.length(text) - 100).alias("viewCount"),
        F.when(turn == 4, 0).when(turn == 3, n_lines + 1).otherwise(n_lines).alias("numAnswers"),
        (turn - 1).cast("int").alias("numMachineAnswers"), (role == "system").alias("isLocked"),
        (turn % 2 == 0).alias("isTrendyQuestion"), role.alias("asker"), answers_text.alias("answers"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    normal = F.to_json(F.struct(*fields), keep_nulls)
    extra = F.to_json(F.struct(*fields, F.lit("x").alias("extra")), keep_nulls)
    missing = F.to_json(F.struct(*fields).dropFields("asker"), keep_nulls)
    doc = F.when(turn == 5, extra).when(turn == 6, missing).otherwise(normal)
    return conv.select(qid.alias("qid"), doc.alias("json"))


_SQL_BASE = """
q AS (
  SELECT conv_id, turn, role, text, string_split(text, chr(10)) AS lines, turn IN (5, 6) AS key_bad
  FROM conversations
),
qa AS (
  SELECT *, CASE WHEN turn = 4 THEN 0 ELSE len(lines) END AS n_ans,
         CASE WHEN turn = 4 THEN 0 WHEN turn = 3 THEN len(lines) + 1 ELSE len(lines) END AS declared
  FROM q WHERE NOT key_bad
),
ans AS (
  SELECT conv_id, turn, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM qa WHERE turn <> 4
),
ans_all AS (
  SELECT conv_id, turn, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM q WHERE turn <> 4
)"""

_SQL_LONG = (f"list_sum(list_transform(string_split(line, ', '), lambda c: "
             f"len(list_filter(string_split(c, ' '), lambda w: length(w) > {LONG_WORD}))))")

_Q_COUNTS = """
  (SELECT count(*) FROM q) AS "Question number",
  (SELECT count(*) FILTER (WHERE key_bad) FROM q) AS "Question Key Not Match",
  (SELECT count(*) FILTER (WHERE role = 'system') FROM qa) AS "Question Null URL",
  (SELECT count(*) FILTER (WHERE turn = 1) FROM qa) AS "Question Null Title",
  (SELECT count(*) FILTER (WHERE role = 'system') FROM qa) AS "Question Locked",
  (SELECT count(*) FILTER (WHERE turn % 2 = 0) FROM qa) AS "Question Trendy",
  (SELECT count(*) FILTER (WHERE length(text) % 50 - 3 < 0) FROM qa) AS "Question Negative follower Count",
  (SELECT count(*) FILTER (WHERE length(text) - 100 < 0) FROM qa) AS "Question Negative View Count",
  (SELECT count(*) FILTER (WHERE declared < 0) FROM qa) AS "Question Negative Answer Num",
  (SELECT count(*) FILTER (WHERE turn - 1 < 0) FROM qa) AS "Question Negative Machine Answer Num",
  (SELECT count(*) FILTER (WHERE turn = 7) FROM qa) AS "Question Negative Creation Time\""""

_A_COUNTS = f"""
  (SELECT coalesce(sum(n_ans), 0) FROM qa) AS "Answer Number",
  (SELECT count(*) FILTER (WHERE n_ans <> declared OR (declared = 0 AND NOT (turn = 4 AND conv_id % 2 = 0 AND role <> 'system'))) FROM qa) AS "Answer Number Not Match",
  (SELECT count(*) FILTER (WHERE i = 2) FROM ans) AS "Answer Key Not Match",
  (SELECT count(*) FILTER (WHERE regexp_matches(line, '[0-9]')) FROM ans) AS "Answer Sensitive",
  (SELECT count(*) FILTER (WHERE length(line) < 60) FROM ans) AS "Answer ShortContect",
  (SELECT count(*) FILTER (WHERE {_SQL_LONG} > 0) FROM ans) AS "Answer Comment Num Not Match",
  (SELECT count(*) FILTER (WHERE length(line) - 30 < 0) FROM ans) AS "Answer Negative View Num",
  (SELECT count(*) FILTER (WHERE i - 1 < 0) FROM ans) AS "Answer Negative Upvote Num",
  (SELECT count(*) FILTER (WHERE len(string_split(line, ' ')) - 5 < 0) FROM ans) AS "Answer Negative Share Num",
  (SELECT count(*) FILTER (WHERE len(string_split(line, ', ')) < 0) FROM ans) AS "Answer Negative Comment Num\""""


def _sql_profile(counts: str) -> str:
    return (f"WITH {_SQL_BASE}, c AS (SELECT {counts}) "
            "SELECT metric, CAST(value AS BIGINT) AS value FROM c UNPIVOT (value FOR metric IN (COLUMNS(*)))")


@register("qa_profile", _sql_profile(_Q_COUNTS + "," + _A_COUNTS))
def qa_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = question_records(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return questions.question_profile(records)


@register("flag_counters", _sql_profile(_Q_COUNTS))
def flag_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = question_records(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return questions.question_profile(records, which="question")


@register("nested_comment_count", f"""
WITH {_SQL_BASE}
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS qid,
       CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS aid,
       CAST(len(string_split(line, ', ')) AS INTEGER) AS declared,
       CAST(len(string_split(line, ', ')) + {_SQL_LONG} AS INTEGER) AS actual
FROM ans_all
""")
def nested_comment_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = question_records(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return questions.answer_comment_counts(records)


@register("declared_vs_actual", """
SELECT conv_id, CAST(max(turn) + 1 AS BIGINT) AS declared, CAST(count(*) AS BIGINT) AS actual,
       max(turn) + 1 = count(*) AS matches
FROM conversations GROUP BY conv_id
""")
def declared_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    per = conv.groupBy("conv_id").agg((F.max("turn") + 1).alias("declared"), F.count(F.lit(1)).alias("actual"))
    return per.withColumn("matches", F.col("declared") == F.col("actual"))
