import random

import pytest

CLASHING = ("id", "t", "h", "bytes", "score", "scan", "found", "value", "key", "text_key", "copies", "counts", "words_of",
            "text_of", "pii", "epoch", "tokens", "taken", "n0", "stratum", "fingerprint", "licenses", "label", "probe")

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices(LETTERS, k=r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Builds documents from (doc_id, text) or (doc_id, text, lang, source), with clashing extra columns."""

    def build(rows, clashing=True):
        rows = [(*r, "en", "src1")[:4] if len(r) == 2 else r for r in rows]
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows],
                                   "doc_id bigint, text string, lang string, source string, n_chars bigint")
        if clashing:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
        return df

    return build


@pytest.fixture()
def tricky():
    """Rows with nulls, empty, blank, repeated and very long texts."""
    long = words(1, 30_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two words"), (6, long), (6, long), (7, long), (None, "no id here at all"),
            (None, None), (8, words(2, 200)), (9, words(2, 200)), (10, "é ñ ü \U0001f600 end"), (11, "a" * 50_000)]


EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"
