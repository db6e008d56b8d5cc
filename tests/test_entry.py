"""Driver contract: entry smoke run, query/oracle keys, differential check."""

import os

import pytest

import __spark_entry__ as entry_mod
from threadsift.plans import registry
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.01"
FAST = (
    "hot_words_overall", "hot_words_grouping_sets", "issue_extract_pipeline", "markup_clean",
    "qa_profile", "stratified_folds", "confidence_boxplot", "true_label_metrics", "cleaning_counters",
    "synonym_augment", "news_clean", "text_length_profile",
)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["source", "word", "freq", "rank"]
    assert len(rows) > 0 and all(1 <= r.rank <= 10 for r in rows)


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    core = {name for name in set(q) - set(o) if name in registry.QUERIES}
    assert core == {"random_sample", "train_score"}


def _names():
    if os.environ.get("THREADSIFT_FULL_ORACLE"):
        entry_mod.oracle_sql()
        return sorted(registry.ORACLE_SQL)
    return list(FAST)


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", _names())
def test_matches_duckdb(spark, duck, name):
    status, n, detail = compare(spark, duck, SF, name)
    assert status == "ok", detail
    assert n > 0
