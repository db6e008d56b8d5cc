"""A dataset replaced by one derived from it, and crashes on the way."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from threadsift.sources import sinks


@pytest.fixture()
def place(spark, tmp_out):
    path = tmp_out + "/data"
    spark.range(1000).write.parquet(path)
    return path


def ids(spark, path):
    return spark.read.parquet(path).agg(F.count("*"), F.max("id")).first()


def neighbours(path):
    return sorted(f for f in os.listdir(os.path.dirname(path)) if not f.startswith("."))


def test_a_dataset_is_replaced_by_its_own_sample(spark, place):
    for n in (500, 100):
        df = spark.read.parquet(place)
        sinks.write_replacement(df.where(F.col("id") < n), place)
        assert tuple(ids(spark, place)) == (n, n - 1) and neighbours(place) == ["data"]
    new = place + "2"
    sinks.write_replacement(spark.range(3), new + "/")  # nothing there yet
    assert ids(spark, new)[0] == 3 and neighbours(place) == ["data", "data2"]


def test_a_failed_job_leaves_the_old_dataset(spark, place):
    bad = spark.read.parquet(place).select(F.when(F.col("id") == 900, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_replacement(bad, place)
    assert tuple(ids(spark, place)) == (1000, 999)
    sinks.recover_replacement(spark, place)
    assert tuple(ids(spark, place)) == (1000, 999) and neighbours(place) == ["data"]


@pytest.mark.parametrize("renames", [0, 1])
def test_a_crash_between_the_renames_is_finished(spark, place, monkeypatch, renames):
    real, done = sinks._rename, []

    def dies(fs, source, target):
        if len(done) == renames:
            raise KeyboardInterrupt
        done.append(target)
        real(fs, source, target)

    monkeypatch.setattr(sinks, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_replacement(spark.read.parquet(place).where("id < 7"), place)
    monkeypatch.setattr(sinks, "_rename", real)
    assert len(neighbours(place)) == 2
    assert sinks.recover_replacement(spark, place) == "finished"
    assert tuple(ids(spark, place)) == (7, 6) and neighbours(place) == ["data"]
    assert sinks.recover_replacement(spark, place) == "clean"


def test_a_crash_before_the_last_delete(spark, place, monkeypatch):
    spark.range(1).write.parquet(place + sinks.REPLACED)
    assert sinks.recover_replacement(spark, place) == "clean"
    assert tuple(ids(spark, place)) == (1000, 999) and neighbours(place) == ["data"]


def test_a_killed_driver(spark, place):
    """The process dies after the old dataset was moved away; the next call finds a complete successor."""
    code = f"""
import os
from threadsift.session import local_session
from threadsift.sources import sinks
spark = local_session(2, 2)
real = sinks._rename
def once(fs, source, target):
    real(fs, source, target)
    os._exit(9)
sinks._rename = once
sinks.write_replacement(spark.read.parquet({place!r}).where("id < 5"), {place!r})
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                          capture_output=True, timeout=120)
    assert done.returncode == 9 and not os.path.exists(place)
    with pytest.raises(RuntimeError, match="read it again"):
        sinks.write_replacement(spark.range(2), place)
    assert tuple(ids(spark, place)) == (5, 4)
    sinks.write_replacement(spark.range(2), place)
    assert tuple(ids(spark, place)) == (2, 1) and neighbours(place) == ["data"]
