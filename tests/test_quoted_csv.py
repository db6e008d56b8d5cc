"""CSV with quoted newlines, read by many tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.sources import readers

FIELDS = ("id", "title", "text")
SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])


def rows(seed, n, longest=60):
    r = random.Random(seed)
    bits = ["a", "b c", "\n", "\n\n", '"', '""', ",", "\r\n", "é", "x\ny", '"q"', "\t", "\\", "'"]
    return [[str(i), "".join(r.choices(bits, k=r.randint(0, 4))), "".join(r.choices(bits, k=r.randint(0, longest)))] for i in range(n)]


def write(path, records, end="\n", header=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerows(([list(FIELDS)] if header else []) + records)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def plain(df):
    return sorted(tuple(x or "" for x in r) for r in df.collect())


@pytest.mark.parametrize("end, header", [("\n", True), ("\r\n", True), ("\n", False)])
def test_a_split_file_equals_one_task_a_file(spark, tmp_out, small_splits, end, header):
    records = rows(1, 400) + [["long", "t", "line\n" * 3000]] + [["last", "", "z"]]  # one record spans many blocks
    for name, part in (("a.csv", records), ("b.csv", rows(2, 30)), ("c.csv", [])):
        write(f"{tmp_out}/{name}", part, end, header)
    assert spark.read.text(tmp_out).rdd.getNumPartitions() > 10
    good, bad = readers.read_csv_exact(spark, tmp_out, SCHEMA, header=header, multi_line=True)
    assert bad.count() == 0
    assert plain(good) == sorted(tuple(r) for r in records + rows(2, 30))
    if header:  # without one, Spark's own reader takes the kind of break from inside the first record and loses rows
        one_task = spark.read.schema(SCHEMA).option("header", header).option("multiLine", True).option("escape", '"').csv(tmp_out)
        # it also turns CRLF inside fields into LF; here fields stay as written
        same = lambda rows: sorted(tuple(x.replace("\r\n", "\n") for x in r) for r in rows)
        assert same(plain(good)) == same(plain(one_task))


def test_wrong_arity_goes_to_the_quarantine(spark, tmp_out, small_splits):
    records = rows(3, 300)
    records[50] = ["too", "few\nlines"]
    records[51] = ["one", "too", "many", "fields\n"]
    write(f"{tmp_out}/a.csv", records)
    good, bad = readers.read_csv_exact(spark, tmp_out, SCHEMA, multi_line=True)
    assert good.count() == 298 and good.where("id in ('too', 'one')").count() == 0
    assert sorted(r.raw for r in bad.collect()) == ['one,too,many,"fields\n"', 'too,"few\nlines"']


def test_records_are_numbered_and_blank_lines_left_out(spark, tmp_out, small_splits):
    with open(f"{tmp_out}/a.csv", "w") as f:
        f.write('h\n\n"a\n\nb"\n\n\nc')
    got = readers.read_quoted_records(spark, tmp_out).orderBy("_record").collect()
    assert [r.record for r in got] == ["h", '"a\n\nb"', "c"]
    assert len({r._record for r in got}) == 3 and got[0]._record == 0


def test_text_column_of_a_csv(spark, tmp_out, small_splits):
    records = rows(4, 200)
    write(f"{tmp_out}/a.csv", records)
    got = readers.read_csv_with_text(spark, f"{tmp_out}/a.csv", multi_line=True)
    assert got.columns == ["text"] and sorted(r.text or "" for r in got.collect()) == sorted(r[2] for r in records)


def test_most_records_cross_one_shuffle(spark, tmp_out, small_splits):
    write(f"{tmp_out}/a.csv", rows(5, 500))
    out = readers.read_quoted_records(spark, tmp_out)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Python" not in plan
    assert plan.count("FileScan text") - plan.count("ReusedExchange") <= 2


def test_an_empty_file_keeps_its_number(spark, tmp_out):
    for side in ("texts", "labels"):
        import os

        os.makedirs(f"{tmp_out}/{side}")
        for i in range(3):
            with open(f"{tmp_out}/{side}/{i}.txt", "w") as f:
                f.write("" if i == 1 and side == "texts" else f"{side} {i}\n")
    texts = readers.read_text_lines_indexed(spark, f"{tmp_out}/texts", "text").collect()
    labels = readers.read_text_lines_indexed(spark, f"{tmp_out}/labels", "label").where(F.col("file") != 1).collect()
    assert {(r.file, r.text[-1]) for r in texts} == {(r.file, r.label[-1]) for r in labels} == {(0, "0"), (2, "2")}
