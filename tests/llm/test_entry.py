import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
import corpus_pipeline
from tests.oracle_check import _rows, duck_connection
from threadsift.llm import entry

SMALL = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in entry_mod.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_mod.queries()
    assert set(entry.ORACLE_SQL) <= set(entry.QUERIES)


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duck_connection(SMALL)
    found = entry.QUERIES[name](spark, SMALL)
    want = con.execute(entry.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == _rows(columns, want.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[4] == sizes[3] > 0
    assert docs.where("text rlike '[a-z0-9.]+@mail[0-9]'").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert out.count() > 0 and {"epoch", "tokens", "taken"} <= set(out.columns)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0, name


def test_stages_on_tricky_rows(spark, frame, tricky):
    """Nulls in every column, repeated rows and ids, long texts, columns with the operators' own names."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(80)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()] + [(*t, None, None) for t in tricky]
    df = frame(rows + rows[:10] + [(rows[0][0], "another text of the same id", "en", "src1")]).withColumns(
        {c: F.lit(7) for c in ("t1", "t2", "n_hit", "items", "join_part", "crowded", "segment", "members", "point")})
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SMALL)
        assert out.columns == df.columns, name
        sizes.append(out.count())
        assert set(r["items"] for r in out.select("items").collect()) <= {7}, name
    assert max(sizes) <= df.count() and sizes[3] == df.count() and min(sizes) > 0
    taken = corpus_pipeline.STAGES[-1][1](spark, df, SMALL)
    assert taken.count() > 0 and set(df.columns) <= set(taken.columns)
