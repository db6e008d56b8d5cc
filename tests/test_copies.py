"""Rows that repeat: numbering, sampling, sorting and shuffling."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadsift.operators import copies, sample, sorting


@pytest.fixture()
def hot(spark):
    """20,000 rows, 7,000 of them one and the same."""
    rows = spark.range(13_000).select(F.col("id"), F.concat(F.lit("t"), F.col("id")).alias("copies"))
    same = spark.range(7_000).select(F.lit(None).cast("bigint").alias("id"), F.lit("same").alias("copies"))
    return rows.union(same)


def parts(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().collect()


def test_numbers_of_equal_rows(spark, hot):
    out = copies.numbered_copies(hot, "nth")
    got = out.groupBy("id", "copies").agg(F.count("*").alias("n"), F.count_distinct("nth").alias("d"), F.max("nth").alias("m"))
    assert got.where("n != d or m != n - 1").count() == 0 and out.count() == 20_000
    assert out.where("copies = 'same'").count() == 7_000


def test_many_copies_are_made_by_many_tasks(spark):
    runs = spark.createDataFrame([("a", 50_001), ("b", 3), ("c", 0), ("d", None)], "v string, n bigint")
    out = copies.repeated(runs, "n", "nth", chunk=1000)
    assert {r.v: (r.c, r.m) for r in out.groupBy("v").agg(F.count("*").alias("c"), F.max("nth").alias("m")).collect()} == {
        "a": (50_001, 50_000), "b": (3, 2)}
    assert len(parts(out.where("v = 'a'"))) >= 4


def test_random_sample_takes_copies_by_their_share(spark, hot):
    for seed in range(4):
        taken = sample.random_sample(hot, 1000, seed)
        rows = Counter(taken.toPandas()["copies"])
        assert sum(rows.values()) == 1000
        assert 270 <= rows.pop("same") <= 430  # expected 350, deviation some 15
        assert set(rows.values()) == {1}


def test_random_sample_sizes_and_layouts(spark, hot):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(sample.random_sample(hot, 200, 3)) == key(sample.random_sample(hot.repartition(5), 200, 3))
    assert sample.random_sample(hot, 0).count() == 0
    assert sample.random_sample(hot, 30_000).count() == 20_000
    assert sample.random_sample(hot.where("false"), 5).count() == 0
    n = hot.agg((F.count("*") / 100).cast("bigint")).scalar()
    assert sample.random_sample(hot, n).count() == 200
    one = spark.range(5000).select(F.lit("x").alias("v"))
    assert sample.random_sample(one, 123).count() == 123


def test_hash_sample_with_repeated_ids(spark):
    rows = [(i, "a") for i in range(300)] + [(7, f"b{i % 40}") for i in range(200)] + [(None, "z")] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, copies string")
    import hashlib

    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.md5(str(r[0]).encode()).hexdigest()))
    for n in (0, 1, 50, 150, 250, 400, 499, 500, 503, 600):
        got = [tuple(r) for r in sample.hash_sample(df, n, "doc_id").collect()]
        assert Counter(r[0] for r in got) == Counter(r[0] for r in order[:n]), n
        assert not Counter(got) - Counter(rows)
    again = [Counter(tuple(r) for r in sample.hash_sample(d, 250, "doc_id").collect()) for d in (df, df.repartition(7))]
    assert again[0] == again[1]


def test_size_target_reads_ids_and_sizes_first(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "n_chars")
    out = sample.size_target_sample(docs, F.col("n_chars"), 100_000, "doc_id")
    total = docs.agg(F.sum("n_chars")).first()[0]
    assert out.count() == int(docs.count() * (100_000 / total))
    capsys.readouterr()
    out.explain("formatted")
    schemas = {line for line in capsys.readouterr().out.splitlines() if line.startswith("ReadSchema")}
    assert schemas == {"ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>", "ReadSchema: struct<doc_id:bigint,n_chars:bigint>",
                       "ReadSchema: struct<doc_id:bigint>"}


def test_one_row_repeated_is_sorted_by_many_tasks(spark):
    df = spark.range(200_000).select(F.lit(5).alias("k"), F.lit("row").alias("v"))
    out = sorting.range_sorted(df, "k", 8)
    sizes = [r["count"] for r in parts(out)]
    assert sum(sizes) == 200_000 and len(sizes) >= 6 and max(sizes) < 60_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are small enough for one task
    try:
        places = Counter(r.p for r in sample.full_shuffle(df).select(F.spark_partition_id().alias("p")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(places.values()) == 200_000 and max(places.values()) < 60_000


def test_sorted_rows_keep_duplicates_and_order(spark, hot, tmp_out):
    from threadsift.sources import sinks

    df = hot.select(F.coalesce("id", F.lit(6000)).alias("id"), "copies")
    sinks.write_sorted_tsv(df, tmp_out + "/s", "id", 6)
    lines = [(r.f, int(r.value.split("\t")[0])) for r in spark.read.text(tmp_out + "/s").select(
        F.col("_metadata.file_name").alias("f"), "value", F.monotonically_increasing_id().alias("i")).orderBy("f", "i").collect()]
    assert [v for _, v in lines] == sorted(r.id for r in df.collect())
    assert len({f for f, v in lines if v == 6000}) >= 2


def test_shuffle_separates_copies(spark, hot):
    order = [r["copies"] for r in sample.full_shuffle(hot, 1).collect()]
    assert Counter(order) == Counter(r["copies"] for r in hot.collect())
    halves = [order[:10_000].count("same"), order[10_000:].count("same")]
    assert min(halves) > 3000
    assert order == [r["copies"] for r in sample.full_shuffle(hot.repartition(3), 1).collect()]
