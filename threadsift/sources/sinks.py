"""Writers for every output shape (SNK1-SNK12) and output size.

All writers are distributed DataFrame writes; only the classification
report (a handful of lines) is written as one file on purpose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(df: DataFrame, columns: Sequence[str], sep: str = "\t") -> DataFrame:
    values = [escape_tsv(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return df.select(F.concat_ws(sep, *values).alias("value"))


def escape_tsv(c: Column) -> Column:
    """Backslash, tab, newline and carriage return as two-character escapes."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, code in (("\t", "t"), ("\n", "n"), ("\r", "r")):
        out = F.replace(out, F.lit(char), F.lit("\\" + code))
    return out


def write_sorted_tsv(df: DataFrame, path: str, key: str, num_files: int | None = None,
                     columns: Sequence[str] | None = None) -> None:
    """SNK1: tab-joined lines in key ranges, each sorted; file i < file i+1.

    ``num_files`` is the number of ranges (the session's shuffle partitions if not given).
    """
    from threadsift.operators.sorting import range_sorted

    columns = list(columns or df.columns)
    _lines(range_sorted(df, key, num_files), columns).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), header: bool = True) -> None:
    """SNK2/SNK6: header CSV; ``partition_by`` splits it into one folder per value."""
    w = df.write.mode("overwrite").option("header", header).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


STAGED, REPLACED = "__staged", "__replaced"


def _moves(spark: SparkSession, path: str):
    """The file system of ``path``, and the paths of the dataset, its staged successor and its replaced self (neighbours of it)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path.rstrip("/"))
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    place = fs.makeQualified(place)
    return fs, place, place.suffix(STAGED), place.suffix(REPLACED), lambda p: hadoop.Path(p, "_SUCCESS")


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def recover_replacement(spark: SparkSession, path: str) -> str:
    """Finishes or undoes what a crash of ``write_replacement`` left behind: the state found.

    ``clean``: nothing to do. ``undone``: the staged write was not complete, the old dataset stays.
    ``finished``: the staged write was complete, the new dataset is in place.
    """
    fs, place, staged, replaced, success = _moves(spark, path)
    state = "clean"
    if fs.exists(staged):
        if fs.exists(success(staged)):  # written by the last step of the job that staged it
            if fs.exists(place):
                fs.delete(replaced, True)
                _rename(fs, place, replaced)
            _rename(fs, staged, place)
            state = "finished"
        else:
            fs.delete(staged, True)
            state = "undone"
    if fs.exists(replaced):
        if fs.exists(place):
            fs.delete(replaced, True)
        else:
            _rename(fs, replaced, place)
            state = "undone"
    return state


def write_replacement(df: DataFrame, path: str) -> None:
    """SNK3: replace the dataset at ``path`` by ``df``, which may be derived from it (e.g. a sample).

    ``df`` is written next to the dataset first, then the two change places by renames, so readers see the old or the new
    dataset. A crash between the steps leaves both: the next call, or ``recover_replacement``,
    finishes the exchange if the new dataset was complete and undoes it if not. One writer at a
    time. Renames must be cheap and whole, as on HDFS or a local disk; on object stores use a table format instead.
    """
    spark = df.sparkSession
    fs, place, staged, replaced, success = _moves(spark, path)
    if fs.exists(staged) or fs.exists(replaced):
        # a plan over the old files would be stale if this finished an exchange
        if recover_replacement(spark, path) == "finished":
            raise RuntimeError(f"an earlier replacement of {path} was finished; read it again")
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(staged.toString())
    if not fs.exists(success(staged)):
        raise OSError(f"{staged} has no success mark")
    if fs.exists(place):
        _rename(fs, place, replaced)
    _rename(fs, staged, place)
    fs.delete(replaced, True)
    spark.catalog.refreshByPath(place.toString())


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """SNK4/SNK8/SNK10/SNK11: tab-separated lines without quoting; tabs and newlines in values are escaped."""
    _lines(df, list(columns or df.columns)).write.mode("overwrite").text(path)


def write_hot_word_reports(ranked: DataFrame, path: str) -> None:
    """SNK5: one report per (source, period): a title line, then ``word: freq`` lines.

    ``ranked`` has ``source, period, word, freq, rank``. Files land in
    ``source=<s>/period=<p>/``; the title sorts first within each file.
    """
    title = ranked.select("source", "period").distinct().select(
        "source", "period", F.lit(0).alias("rank"),
        F.format_string("%s hot words %s:", F.col("source"), F.col("period")).alias("value"))
    body = ranked.select("source", "period", "rank",
                         F.format_string("%s: %d", F.col("word"), F.col("freq")).alias("value"))
    lines = title.unionByName(body)
    (lines.repartition("source", "period").sortWithinPartitions("source", "period", "rank")
     .select("source", "period", "value").write.mode("overwrite").partitionBy("source", "period").text(path))


def write_report(lines: DataFrame, path: str, order_col: str = "i") -> None:
    """SNK7: a small ordered text report as a single file (bounded: a few lines)."""
    lines.orderBy(order_col).select("line").coalesce(1).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """A table as Parquet (for example once after reading multi-line CSV)."""
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """SNK9: one JSON object per line."""
    df.write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """SNK12: persist a fitted pipeline."""
    model.write().overwrite().save(path)


def output_size_mb(spark: SparkSession, path: str) -> float:
    """Total size of the files under ``path`` in MB (file lengths only, no content read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("length"))
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return total / (1024 * 1024)
