"""Question/answer profile on hand-made NDJSON questions."""

import json
import random

from pyspark.sql import functions as F

from threadsift.operators import questions


def _answer(aid, comments, num_comments, **over):
    a = {"aid": aid, "url": "/a", "content": "x", "author": "u", "isSensitive": False,
         "isShortContent": True, "creationTime": 1, "numViews": 1, "numUpvotes": 1,
         "numShares": 1, "numComments": num_comments, "comments": comments}
    a.update(over)
    return a


def _question(qid, answers, **over):
    q = {"qid": qid, "url": "/How-to-x/", "title": "t", "creationTime": 10, "followerCount": 1,
         "viewCount": 1, "numAnswers": len(answers), "numMachineAnswers": 0, "isLocked": False,
         "isTrendyQuestion": True, "asker": "a", "answers": json.dumps(answers)}
    q.update(over)
    return q


def _tree(depth):
    node = []
    for _ in range(depth):
        node = [{"c": 1, "comments": node}]
    return node


QUESTIONS = [
    _question("q1", [_answer("a1", [], 0), _answer("a2", [{"comments": [{"x": 1}]}], 2)]),
    _question("q2", [_answer("a3", _tree(3), 2, isSensitive=True, numViews=-1)], url="", title=None),
    _question("q3", [], numAnswers=0, url="//unanswered/Why/"),
    _question("q4", [], numAnswers=0, isLocked=True, followerCount=-5),
    _question("q5", [_answer("a4", _tree(7), 7, extra=1)], numAnswers=2, creationTime=-1),
    dict(_question("q6", []), extra_key=True),
    {k: v for k, v in _question("q7", []).items() if k != "asker"},
]


def _df(spark):
    return spark.createDataFrame([(json.dumps(q),) for q in QUESTIONS], "json string")


def test_counters(spark):
    got = {r.metric: r.value for r in questions.question_profile(_df(spark)).collect()}
    assert got["Question number"] == 7
    assert got["Question Key Not Match"] == 2
    assert got["Question Null URL"] == 1 and got["Question Null Title"] == 1
    assert got["Question Locked"] == 1 and got["Question Trendy"] == 5
    assert got["Question Negative follower Count"] == 1 and got["Question Negative Creation Time"] == 1
    assert got["Answer Number"] == 4
    # q2 url '' -> first segment '' (count 1 == declared 1, fine); q4 zero answers without
    # the unanswered segment; q5 declares 2 but has 1
    assert got["Answer Number Not Match"] == 2
    assert got["Answer Key Not Match"] == 1
    assert got["Answer Sensitive"] == 1 and got["Answer Negative View Num"] == 1
    # a2 has 2 comments (right), a3 has 3 (declared 2), a4 has 7 nested beyond the unrolled levels (right)
    assert got["Answer Comment Num Not Match"] == 1
    assert len(got) == 21


def test_comment_counts_any_depth(spark):
    counts = {r.aid: (r.declared, r.actual) for r in questions.answer_comment_counts(_df(spark)).collect()}
    assert counts == {"a1": (0, 0), "a2": (2, 2), "a3": (2, 3), "a4": (7, 7)}


def _count(node):
    sub = node.get("comments") if isinstance(node, dict) else None
    return sum(1 + _count(c) for c in sub) if isinstance(sub, list) else 0


def _random_tree(r, depth):
    node = {"text": r.choice(["x", 'a "comments" b', "[1, 2]"]), "n": r.choice([None, 1, 2.5])}
    kind = r.random()
    if kind < 0.1:
        node["comments"] = r.choice([None, "[1, 2]", {"comments": [1]}, 3])  # not a list: no comments
    elif kind < 0.9 and depth:
        node["comments"] = [_random_tree(r, depth - 1) if r.random() < 0.85 else r.choice([None, 1, "c", [{"comments": [1]}]])
                            for _ in range(r.randint(0, 4))]
    return node


def test_comment_counts_of_any_json(spark):
    r = random.Random(3)
    trees = [_random_tree(r, r.randint(0, 6)) for _ in range(200)]
    deep = [{"comments": _tree(50)}, {"comments": _tree(1)}, {}, [], 5, "x", None, [{"comments": [1]}]]
    texts = [json.dumps(t) for t in trees + deep] + ["not json", "", None]
    want = [_count(t) for t in trees + deep] + [0, 0, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [x.n for x in df.select("i", questions.comment_count("t").alias("n")).orderBy("i").collect()] == want
    lists, wrong = [], []
    for _ in range(60):
        answers = [r.choice(trees) for _ in range(r.randint(0, 6))]
        stated = [dict(a, numComments=r.choice([_count(a), 1, None, str(_count(a)), "many"])) for a in answers]
        lists.append(json.dumps(stated))
        wrong.append(sum(str(a["numComments"]).isdigit() and int(a["numComments"]) != _count(a) for a in stated))
    lists += [None, "{}", "junk", "[]"]
    wrong += [None, 0, 0, 0]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, t string")
    assert [x.n for x in df.select("i", questions.comment_mismatches("t").alias("n")).orderBy("i").collect()] == wrong


def test_no_python_in_the_profile(spark, capsys):
    capsys.readouterr()
    questions.question_profile(_df(spark)).explain()
    questions.answer_comment_counts(_df(spark)).explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "Python" not in plan and "Arrow" not in plan
    deep = _question("q", [_answer("a", _tree(50), 49)])
    got = {r.metric: r.value for r in questions.question_profile(
        spark.createDataFrame([(json.dumps(deep),)], "json string")).where(F.col("value") > 0).collect()}
    assert got["Answer Comment Num Not Match"] == 1
