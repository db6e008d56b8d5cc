import random
import re

from tests.llm.conftest import EMPTY, words
from threadsift.llm import pii


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def card(r, n=16):
    body = "".join(r.choices("0123456789", k=n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in rules}


def documents():
    r = random.Random(6)
    made = [lambda: f"u{r.randint(0, 99)}.x@mail{r.randint(0, 9)}.example.com", lambda: ".".join(str(r.randint(0, 300)) for _ in range(4)),
            lambda: card(r), lambda: card(r, 19), lambda: " ".join(re.findall("....", card(r))), lambda: f"+{r.randint(1, 99)} (0{r.randint(10, 99)}) 555-{r.randint(0, 9999):04}",
            lambda: "".join(r.choices("0123456789", k=16)), lambda: f'token = "{r.getrandbits(160):040x}"', lambda: f"{r.getrandbits(64):016x}",
            lambda: str(r.randint(10, 10**9)), lambda: "a@b", lambda: "a@b.c%d@e.f.g", lambda: "é" * 5 + "1.2.3.4.5.6.7.8", lambda: "+1-2-3- 4", lambda: "1 2 3"]
    rows = []
    for i in range(400):
        text = words(i, 40).split()
        for _ in range(r.randint(0, 4)):
            text.insert(r.randrange(len(text)), r.choice(made)())
        rows.append((i, " ".join(text)))
    rows += [(1000, "1 " * 30_000), (1001, "a." * 20_000), (1002, "+1 " * 500 + "9"), (1003, "\U0001f600 x@y.zz"), (1004, "x@y.zz " * 3000),
             (1005, "00255.1.1.0001 256.1.1.1 99999999999999999999.1.1.1"), (1006, "1-1 " * 5 + "@" * 50)]
    return rows


def test_base_spans_and_added_ones(frame, tricky):
    rows = documents() + tricky
    df = frame(rows)
    model = pii.fit(df)
    assert model.thresholds.get("secret") is not None
    found, name = pii.annotate(df, model)
    got = sorted(((r["doc_id"], r[name]) for r in found.select("doc_id", name).collect()), key=lambda x: (str(x[0]), len(x[1]["all"])))
    want = sorted(((d, t, brute(t)) for d, t in rows), key=lambda x: (str(x[0]), len(x[1] or "")))
    by_id = {}
    for d, t, b in want:
        by_id.setdefault(d, []).append((t, b))
    for d, r in got:
        assert any(all(r[k] == b[k] for k in pii.BASE_KINDS) for _, b in by_id[d]), d
        assert {s for k in pii.BASE_KINDS for s in r[k]} <= set(r["all"])
        kinds = [s.split(":")[0] for s in r["all"]]
        assert kinds == sorted(kinds, key=list(pii.PROPOSAL_PATTERNS).index)
    tokens = {d: [f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'token = "([0-9a-f]{40})"', t or "")] for d, t in documents()}
    all_of = {d: r["all"] for d, r in got}
    assert all(set(s) <= set(all_of[d]) for d, s in tokens.items())


def test_redaction(frame, tricky):
    rows = [(d + 2000, t) for d, t in documents()[:60]]
    df = frame(rows + tricky)
    out = pii.redact(df, pii.Model())
    assert out.columns == df.columns and out.count() == df.count()
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    for d, t in rows:
        spans = sorted((int(s.split(":")[1]), int(s.split(":")[2]), k.upper()) for k, v in brute(t).items() for s in v)
        want, reach = "", 0
        for a, b, k in spans:
            if a >= reach:
                want += t[reach:a] + f"<{k}>"
            reach = max(reach, b)
        want += t[reach:]
        assert texts[d] == (want, len(want))
    assert texts[1] == (None, 0) and texts[4] == ("one", 3)


def test_thresholds_keep_precision():
    bins = [{"kind": "a", "bin": b, "n": 10, "right": 10 if b > 60 else 2} for b in range(0, 100, 10)]
    bins += [{"kind": "b", "bin": 90, "n": 10, "right": 5}]
    assert pii.thresholds(bins) == {"a": 0.7}


def test_empty_and_few(spark, frame):
    none = spark.createDataFrame([], EMPTY)
    assert pii.fit(none) == pii.Model() and pii.redact(none, pii.Model()).count() == 0
    assert pii.fit(frame([(1, "mail a@b.cc"), (2, None)])) == pii.Model()


def test_assigned_secrets_at_every_size(frame):
    token = 'x token = "0123456789abcdef0123456789abcdef01234567" y'
    few, many = [(1, token), (2, "nothing here")], [(1, token), *documents()]
    for rows in (few[:1], few, many):
        df = frame(rows)
        model = pii.fit(df)
        found, name = pii.annotate(df.where("doc_id = 1 and text like 'x token%'"), model)
        assert found.first()[name]["all"] == ["secret:11:51"]
        assert pii.redact(df, model).where("text = 'x token = \"<SECRET>\" y'").count() == 1
