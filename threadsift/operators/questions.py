"""Question/answer quality profile (X10: A1, A22-A26, F27, F34, U3).

Input: one question per row as JSON text (column ``json``), whose ``answers``
field is itself a JSON array held in a string. Every counter is a per-row
expression (answers are handled with array functions, never exploded), and
all 21 counters are summed in one aggregate: one scan, one tiny shuffle.

Comments nest to any depth: an answer is parsed once into a VARIANT and its tree is
folded level by level with array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.functions.cols import as_col
from threadsift.functions.text import first_path_segment
from threadsift.operators.profile import counters, keyset_equals

_STR_ARRAY = "array<string>"

# Counter names in the order the profile reports them.
QUESTION_COUNTERS = (
    "Question number",
    "Question Key Not Match",
    "Question Null URL",
    "Question Null Title",
    "Question Locked",
    "Question Trendy",
    "Question Negative follower Count",
    "Question Negative View Count",
    "Question Negative Answer Num",
    "Question Negative Machine Answer Num",
    "Question Negative Creation Time",
)
ANSWER_COUNTERS = (
    "Answer Number",
    "Answer Number Not Match",
    "Answer Key Not Match",
    "Answer Sensitive",
    "Answer ShortContect",
    "Answer Comment Num Not Match",
    "Answer Negative View Num",
    "Answer Negative Upvote Num",
    "Answer Negative Share Num",
    "Answer Negative Comment Num",
)
UNANSWERED = "unanswered"


def _comment_count(answer: Column, levels: Column) -> Column:
    """Comments in the tree of a parsed answer: level by level, until a level holds none.

    ``levels`` is at least the depth of the tree.
    """
    def replies(nodes: Column) -> Column:
        lists = F.transform(nodes, lambda c: F.try_variant_get(c, "$.comments", "array<variant>"))
        return F.flatten(F.filter(lists, lambda x: x.isNotNull()))

    def deeper(state: Column, _: Column) -> Column:
        below = replies(state["nodes"])
        return F.when(F.size(state["nodes"]) == 0, state).otherwise(
            F.struct(below.alias("nodes"), (state["n"] + F.size(below)).alias("n")))

    start = F.struct(F.array(answer).alias("nodes"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(0), levels), start, deeper, lambda state: state["n"])


def _levels(text: Column) -> Column:
    """How often the key of a comment list occurs in a JSON text: no tree in it is deeper."""
    key = '"comments"'
    return ((F.length(text) - F.length(F.replace(text, F.lit(key), F.lit("")))) / len(key)).cast("int")


def comment_count(answer) -> Column:
    """Number of comments in an answer (JSON text), counting nested ones at any depth.

    Null for a null; 0 for what is not a JSON object.
    """
    text = as_col(answer)
    return F.when(text.isNotNull(), F.coalesce(_comment_count(F.try_parse_json(text), _levels(text)), F.lit(0)))


def comment_mismatches(answers) -> Column:
    """Answers of a question (JSON array text) whose ``numComments`` differs from their comment count."""
    text = as_col(answers)
    parsed = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    wrong = F.filter(parsed, lambda a: F.try_variant_get(a, "$.numComments", "int") != _comment_count(a, _levels(text)))
    return F.when(text.isNotNull(), F.coalesce(F.size(wrong), F.lit(0)))


def parse_questions(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Typed question fields plus ``_keys_ok`` and the raw answer texts ``_answers``."""
    q = F.from_json(F.col(json_col), schemas.QUESTION)
    return df.select(
        q.alias("q"),
        keyset_equals(json_col, schemas.QUESTION_KEYS).alias("_keys_ok"),
        F.from_json(q["answers"], _STR_ARRAY).alias("_answers"),
    )


def _answer_flag_count(answers: Column, pred) -> Column:
    return F.size(F.filter(answers, pred))


def _field_int(a: Column, name: str) -> Column:
    return F.get_json_object(a, f"$.{name}").try_cast("int")


def _field_true(a: Column, name: str) -> Column:
    return F.get_json_object(a, f"$.{name}") == "true"


def question_flags(parsed: DataFrame) -> dict[str, Column]:
    """Per-row counter columns; after the key check they count key-matching rows only."""
    q, ok, ans = F.col("q"), F.col("_keys_ok"), F.col("_answers")
    n_ans = F.coalesce(F.size(ans), F.lit(0))
    declared = q["numAnswers"]
    seg = first_path_segment(q["url"])
    answer_keys_ok = lambda a: keyset_equals(a, schemas.ANSWER_KEYS)
    per_row = {
        "Question number": F.lit(1),
        "Question Key Not Match": ~ok,
        "Question Null URL": q["url"] == "",
        "Question Null Title": q["title"].isNull(),
        "Question Locked": q["isLocked"],
        "Question Trendy": q["isTrendyQuestion"],
        "Question Negative follower Count": q["followerCount"] < 0,
        "Question Negative View Count": q["viewCount"] < 0,
        "Question Negative Answer Num": declared < 0,
        "Question Negative Machine Answer Num": q["numMachineAnswers"] < 0,
        "Question Negative Creation Time": q["creationTime"] < 0,
        "Answer Number": n_ans,
        "Answer Number Not Match": (n_ans != declared) | ((declared == 0) & (seg != UNANSWERED)),
        "Answer Key Not Match": _answer_flag_count(ans, lambda a: ~answer_keys_ok(a)),
        "Answer Sensitive": _answer_flag_count(ans, lambda a: _field_true(a, "isSensitive")),
        "Answer ShortContect": _answer_flag_count(ans, lambda a: _field_true(a, "isShortContent")),
        "Answer Comment Num Not Match": comment_mismatches(q["answers"]),
        "Answer Negative View Num": _answer_flag_count(ans, lambda a: _field_int(a, "numViews") < 0),
        "Answer Negative Upvote Num": _answer_flag_count(ans, lambda a: _field_int(a, "numUpvotes") < 0),
        "Answer Negative Share Num": _answer_flag_count(ans, lambda a: _field_int(a, "numShares") < 0),
        "Answer Negative Comment Num": _answer_flag_count(ans, lambda a: _field_int(a, "numComments") < 0),
    }
    always = {"Question number", "Question Key Not Match"}
    return {k: (v if k in always else F.when(ok, v.cast("long")).otherwise(F.lit(0).cast("long")))
            for k, v in per_row.items()}


def question_profile(df: DataFrame, json_col: str = "json", which: str = "all") -> DataFrame:
    """The 21 counters as ``metric, value`` rows (``which``: all|question|answer)."""
    parsed = parse_questions(df, json_col)
    flags = question_flags(parsed)
    if which == "question":
        flags = {k: v for k, v in flags.items() if k in QUESTION_COUNTERS}
    elif which == "answer":
        flags = {k: v for k, v in flags.items() if k in ANSWER_COUNTERS}
    return counters(parsed, flags)


def answer_comment_counts(df: DataFrame, json_col: str = "json", id_field: str = "qid") -> DataFrame:
    """A25 per answer: ``qid, aid, declared, actual`` (answers exploded here on purpose)."""
    parsed = parse_questions(df, json_col)
    ans = parsed.select(F.col("q")[id_field].alias("qid"), F.explode("_answers").alias("a"))
    return ans.select("qid", F.get_json_object("a", "$.aid").alias("aid"),
                      _field_int(F.col("a"), "numComments").alias("declared"),
                      comment_count("a").alias("actual"))
