import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import EMPTY, words
from threadsift.llm import suffix_dedup


def brute(rows, length=200):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, np.int32)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        flag = np.cumsum(gone[:-1]) > 0
        runs = int((flag & ~np.append(False, flag[:-1])).sum()) if len(flag) else 0
        out.append((d, len(t), int(flag.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~flag])))
    return sorted(out, key=str)


def planted():
    r = random.Random(12)
    base = [words(i, 150) for i in range(30)]
    passages = [words(900 + i, 45)[:n] for i, n in enumerate((199, 200, 201, 230, 150))]
    rows = []
    for i in range(160):
        text = r.choice(base) if i % 4 else words(2000 + i, r.randint(1, 200))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(text))
            text = text[:at] + r.choice([*passages, "é", "x", ""]) + text[at + r.randint(0, 2):]
        rows.append((i, text))
    rows += [(500 + i, words(5000 + i, 60) + passages[3] + words(7000 + i, 60)) for i in range(40)]
    return rows + [(800, "ab" * 400), (801, "ab" * 300), (802, "a" * 199), (803, "z" * 200), (804, "z" * 200), (805, "é" * 300), (806, words(3, 40) * 3)]


@pytest.mark.parametrize("limit", [suffix_dedup.GROUP_LIMIT, 2])
def test_matches_brute_force(frame, tricky, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    rows = planted() + [(d, t and t[:20_000]) for d, t in tricky]
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in suffix_dedup.dedup(frame(rows)).collect()), key=str)
    assert got == brute(rows)


def test_small_collections(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 3)
    rows = planted()
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in suffix_dedup.dedup(frame(rows)).collect()), key=str)
    assert got == brute(rows)


def test_pieces_of_a_block(frame, monkeypatch):
    import pyarrow as pa

    from threadsift.llm import arrays

    texts = pa.array([t for _, t in planted()])
    whole = suffix_dedup.anchors(texts).to_pylist()
    monkeypatch.setattr(arrays, "BLOCK_BYTES", 333)
    arrays._powers.clear()
    pieces = suffix_dedup.anchors(texts).to_pylist()
    arrays._powers.clear()
    covered = lambda rows: [[(a["place"] >> 16) + i for a in r for i in range((a["place"] >> 8) & 0xFF)] for r in rows]
    assert covered(whole) == covered(pieces) == [list(range(max(0, len(t.encode()) - 199))) for _, t in planted()]


@pytest.mark.parametrize("seed", range(6))
def test_column_wise_order(seed):
    r = np.random.default_rng(seed)
    docs = [r.integers(0, 3, r.integers(0, 25)) for _ in range(14)] + [np.zeros(9, int)] * 2
    lengths = np.array([len(d) for d in docs])
    symbols = np.zeros((len(docs), max(1, lengths.max())), np.int16)
    for i, d in enumerate(docs):
        symbols[i, :len(d)] = d[::-1]
    document, size, prefix = suffix_dedup.column_wise_order(symbols, lengths)
    suffixes = [tuple(docs[d][len(docs[d]) - s:]) + (-1 - len(docs) + d,) for d, s in zip(document, size)]
    assert suffixes == sorted(suffixes) and len(suffixes) == sum(lengths + 1)
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        common = next(j for j in range(len(a)) if j >= len(b) or a[j] != b[j])
        assert prefix[i] == common


def test_empty(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], EMPTY)).count() == 0
