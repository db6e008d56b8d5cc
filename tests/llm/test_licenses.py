import random

from tests.llm.conftest import EMPTY, words
from threadsift.llm import licenses


def test_families_are_found_and_text_is_left_alone(frame, tricky):
    r = random.Random(5)
    rows, want = [], {}
    for i in range(300):
        lines = [words(10 * i + j, r.randint(3, 200)) for j in range(4)]
        families = set()
        if i % 3 == 0:
            family = r.choice(sorted(licenses.TEMPLATES))
            line = r.choice(licenses.TEMPLATES[family])
            lines.insert(r.randrange(5), r.choice([line, line.upper(), line.replace(" ", "$$ ")]))
            families = {family}
        rows.append((100 + i, "\n".join(lines)))
        want[100 + i] = families
    rows += [(1000, "the license plate of the version was granted to the public"), (1001, None)]
    df = frame(rows + [(d and d + 5000, t) for d, t in tricky])
    found, name = licenses.scan(df, licenses.fit(df))
    got = {x["doc_id"]: {f["family"] for f in x[name]} for x in found.collect()}
    assert got[1000] == got[1001] == set()
    hit = sum(want[d] <= got[d] for d in want if want[d])
    assert hit >= 0.97 * sum(bool(f) for f in want.values())
    wrong = [d for d in want if got[d] - want[d] and not want[d]]
    assert not wrong and not any(got.get(d and d + 5000) for d, _ in tricky)


def test_windows_cover_paragraphs():
    import numpy as np

    cuts = np.array([0, 5, 5 + licenses.WINDOW, 5 + licenses.WINDOW + 250])
    starts, ends = licenses.windows(cuts)
    assert starts[0] == 0 and ends[0] == 5 and (ends - starts <= licenses.WINDOW).all()
    for a, b in zip(cuts[:-1], cuts[1:]):  # every run of STEP words lies in one window
        for at in range(a, max(a, b - licenses.STEP) + 1):
            assert any(s <= at and min(at + licenses.STEP, b) <= e for s, e in zip(starts, ends))


def test_empty(spark, frame):
    none = spark.createDataFrame([], EMPTY)
    model = licenses.fit(none)
    assert licenses.scan(none, model)[0].count() == 0
    found, name = licenses.scan(frame([(1, "Released under the MIT License.")]), model)
    assert found.first()[name][0]["family"] == "mit"


_MODEL = []


def _families(frame, texts):
    if not _MODEL:
        _MODEL.append(licenses.fit(frame([(i, "\n".join(words(10 * i + j, 60) for j in range(4))) for i in range(60)])))
    found, name = licenses.scan(frame([(1000 + i, t) for i, t in enumerate(texts)]), _MODEL[0])
    return [set(f["family"] for f in r[name]) for r in found.orderBy("doc_id").collect()]


def test_wrapped_notices(frame):
    import textwrap

    texts, want = [], []
    for family, templates in sorted(licenses.TEMPLATES.items()):
        for i, template in enumerate(templates):
            for width in (35, 70):
                for prefix in ("", " * ", "# "):
                    wrapped = textwrap.indent("\n".join(textwrap.wrap(template, width)), prefix)
                    texts += [wrapped, f"{words(i, 90)}\n{wrapped}\n{words(i + 1, 90)}"]
                    want += [family, family]
    got = _families(frame, texts)
    missed = [(w, t) for g, w, t in zip(got, want, texts) if w not in g]
    assert not missed, (len(missed), len(texts), missed[:5])
    assert not any(_families(frame, [words(5, 400), "This Source Code Form is subject to the terms\n\nof the Mozilla Public License, v. 2.0."]))


def test_short_notice(frame):
    assert _families(frame, ["All rights reserved.", f"{words(1, 80)}\nAll rights\nreserved.\n{words(2, 80)}",
                             "rights reserved for all"]) == [{"proprietary"}, {"proprietary"}, set()]
    short = licenses.text_words("All rights reserved.")
    model = licenses.fit_words([short] * 200 + [licenses.text_words(words(i, 8)) for i in range(200)])
    start = licenses.np.array([0])
    assert model.log_odds(short, start, start + 3)[0, model.families.index("proprietary") - 1] > 0


def test_two_licences_on_one_line(frame):
    texts, want = [], []
    for a, b in (("mit", "apache-2.0"), ("bsd", "cc0"), ("gpl-2.0", "gpl-3.0"), ("cc-by", "cc-by-sa"), ("lgpl", "mpl-2.0")):
        for x in licenses.TEMPLATES[a]:
            for y in licenses.TEMPLATES[b]:
                texts += [f"{x} {y}", f"{y} {x}"]
                want += [{a, b}] * 2
    got = _families(frame, texts)
    assert all(w <= g for g, w in zip(got, want)), [(t, g) for g, w, t in zip(got, want, texts) if not w <= g]


def test_families_are_weighed_each_against_unknown():
    scanner = licenses.Scanner(licenses.fit_words([]))
    scanner.model.thresholds = licenses.np.zeros(len(licenses.TEMPLATES), int)
    line = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0."
    found = scanner.scan(licenses.pa.array([line])).to_pylist()[0]
    assert {f["family"] for f in found} == {"mit", "apache-2.0"}


def test_thresholds_are_those_of_all_documents(frame):
    texts = [words(i, 150) for i in range(60)]
    rows = list(enumerate(texts + texts[:1] * 300))
    model = licenses.fit(frame(rows), max_documents=20)
    unknown = licenses.Scanner(model).unknown(licenses.pa.array([t for _, t in rows]))
    assert (model.thresholds == licenses.thresholds(unknown)).all()


def test_copies_do_not_use_up_the_sample(frame, monkeypatch):
    from pyspark.sql import functions as F

    df = frame([(i, words(i, 30)) for i in range(40)])
    first = df.orderBy(F.xxhash64("text")).first()["text"]
    once, copied = licenses.fit(df, max_documents=10), licenses.fit(df.union(frame([(100 + i, first) for i in range(50)])), max_documents=10)
    assert (once.weights == copied.weights).all()


def test_words_of_another_version_are_not_a_second_licence():
    scanner = licenses.Scanner(licenses.fit_words([]))
    scanner.model.thresholds = licenses.np.zeros(len(licenses.TEMPLATES), int)
    for family in ("gpl-2.0", "gpl-3.0"):
        found = scanner.scan(licenses.pa.array([licenses.TEMPLATES[family][0]])).to_pylist()[0]
        assert {f["family"] for f in found} == {family}
