"""Declared schemas for every source and for the canonical post record."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


# F-ISSUE: extracted issues (NDJSON).
ISSUE = _strings("id", "created_at", "url", "title", "body")

# F-ISSUE-RAW: event rows before extraction (payload is JSON text).
ISSUE_EVENT = T.StructType([
    T.StructField("id", _S), T.StructField("created_at", T.TimestampType()),
    T.StructField("type", _S), T.StructField("payload", _S), T.StructField("day", _S),
])

# F-NEWS: seven-column CSV, all text on read.
NEWS_FIELDS = ("id", "title", "text", "by", "score", "time", "type")
NEWS = _strings(*NEWS_FIELDS)

# F-QA: thirteen-column CSV with header, all text on read.
QA_FIELDS = ("Id", "PostTypeId", "ParentId", "CreationDate", "Score", "ViewCount", "Title",
             "Tags", "Body", "OwnerUserId", "AnswerCount", "CommentCount", "FavoriteCount")
QA = _strings(*QA_FIELDS)

# F-QUESTION: question with an answers array held as JSON text.
QUESTION_KEYS = ("qid", "url", "title", "creationTime", "followerCount", "viewCount",
                 "numAnswers", "numMachineAnswers", "isLocked", "isTrendyQuestion", "asker", "answers")
ANSWER_KEYS = ("aid", "url", "content", "author", "isSensitive", "isShortContent",
               "creationTime", "numViews", "numUpvotes", "numShares", "numComments", "comments")
QUESTION = T.StructType([
    T.StructField("qid", _S), T.StructField("url", _S), T.StructField("title", _S),
    T.StructField("creationTime", T.LongType()), T.StructField("followerCount", T.IntegerType()),
    T.StructField("viewCount", T.IntegerType()), T.StructField("numAnswers", T.IntegerType()),
    T.StructField("numMachineAnswers", T.IntegerType()), T.StructField("isLocked", T.BooleanType()),
    T.StructField("isTrendyQuestion", T.BooleanType()), T.StructField("asker", _S),
    T.StructField("answers", _S),
])
ANSWER = T.StructType([
    T.StructField("aid", _S), T.StructField("url", _S), T.StructField("content", _S),
    T.StructField("author", _S), T.StructField("isSensitive", T.BooleanType()),
    T.StructField("isShortContent", T.BooleanType()), T.StructField("creationTime", T.LongType()),
    T.StructField("numViews", T.IntegerType()), T.StructField("numUpvotes", T.IntegerType()),
    T.StructField("numShares", T.IntegerType()), T.StructField("numComments", T.IntegerType()),
    T.StructField("comments", _S),
])

# F-TEXT: headerless (time, content) TSV per source.
TIMED_TEXT = _strings("time", "content")

# Output tables declared over the cleaned data.
QA_CLEAN = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("post_type_id", T.ByteType()),
    T.StructField("text", _S), T.StructField("cleaned_tags", _S),
    T.StructField("create_date", T.TimestampType()), T.StructField("score", T.IntegerType()),
])
NEWS_CLEAN = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", _S), T.StructField("text", _S),
    T.StructField("by", _S), T.StructField("score", T.IntegerType()),
    T.StructField("time", T.TimestampType()), T.StructField("type", _S),
])
QUESTION_CLEAN = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("text", _S)])
ISSUE_CLEAN = _strings("id", "time", "text", "source")

# F-LABEL and F-SCORE.
LABELLED = T.StructType([T.StructField("text", _S), T.StructField("label", T.IntegerType())])
SCORED = T.StructType([
    T.StructField("text", _S), T.StructField("predicted_label", _S),
    T.StructField("confidence", T.DoubleType()),
])

# Canonical post record all sources converge on.
POSTS = T.StructType([
    T.StructField("source", _S), T.StructField("id", _S), T.StructField("ts", T.TimestampType()),
    T.StructField("text", _S), T.StructField("title", _S),
    T.StructField("tags", T.ArrayType(_S)), T.StructField("author", _S),
    T.StructField("score", T.IntegerType()), T.StructField("kind", _S),
])
