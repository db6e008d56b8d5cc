import random
import re

import pytest

from tests.llm.conftest import EMPTY, words
from threadsift.llm import decontaminate


def split(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def planted():
    r = random.Random(4)
    items = [(i, words(1000 + i, r.randint(14, 60))) for i in range(20)]
    items += [(50, "tiny item here"), (51, "Just ONE, short item of seven words"), (52, None), (53, "..."), (None, words(77, 20)),
              (54, "so so so so so so so so so so so so so so so so so"), (55, items[3][1]), (3, items[3][1])]
    docs = []
    for i in range(120):
        text = words(5000 + i, r.randint(5, 300)).split()
        item = split(items[r.randrange(len(items))][1])
        if item and i % 2:
            start = r.randrange(len(item))
            at = r.randrange(len(text))
            text[at:at] = item[start:start + r.choice([5, 12, 13, 14, 40])]
        docs.append((i, r.choice([" ", "\n", ", ", "--"]).join(text).title()))
    return items, docs + [(900, "so " * 40), (901, items[3][1] + " " + items[4][1])]


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("short", [True, False])
def test_matches_brute_force(spark, frame, tricky, broadcast, short):
    items, docs = planted()
    if not short:
        items = [(i, t) for i, t in items if len(split(t)) >= 13]
    docs += tricky + [(3000 + i, docs[1][1]) for i in range(50)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for limit in () if broadcast else limits:  # every join by a shuffle
            spark.conf.set(limit, "-1")
        df, name = decontaminate.scan(frame(docs), benchmark)
        got = sorted(((r["doc_id"], *r[name]) for r in df.collect()), key=str)
    finally:
        for limit in limits:
            spark.conf.unset(limit)
    want = brute(docs, items)
    assert got == want and any(w[4] for w in want)


def test_stage_and_empty_tables(spark, frame, tricky):
    items, docs = planted()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    df = frame(docs + tricky)
    kept = decontaminate.drop_contaminated(df, benchmark)
    assert kept.columns == df.columns
    assert kept.count() == sum(not w[4] for w in brute(docs + tricky, items))
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(df, none).count() == df.count()
    assert decontaminate.drop_contaminated(spark.createDataFrame([], EMPTY), benchmark).count() == 0
