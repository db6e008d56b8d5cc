"""Readers for every source shape (SRC1-SRC14), each with a quarantine.

Each reader takes an explicit schema and returns ``(good, bad)``: rows that
conform and rows that do not, the latter with the raw text and an ``error``
column. Nothing is silently dropped, and nothing is inferred from the data,
so the scan is a single pass with column pruning.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift import schemas

CORRUPT = "_corrupt_record"


def day_range_filter(ts_col: str, first_day: str, last_day: str) -> Column:
    """Inclusive day range as a half-open timestamp range (pushes down)."""
    lo = F.lit(first_day).cast("date")
    hi = F.date_add(F.lit(last_day).cast("date"), 1)
    ts = F.col(ts_col)
    return (ts >= lo.cast("timestamp_ntz")) & (ts < hi.cast("timestamp_ntz"))


def read_day_sharded(spark: SparkSession, path: str, first: str, last: str,
                     day_col: str = "day", fmt: str = "parquet") -> DataFrame:
    """SRC1: a table partitioned by a ``day`` folder, pruned to [first, last].

    The filter is on the partition column, so folders outside the range are
    never listed for reading (partition pruning).
    """
    df = spark.read.format(fmt).load(path)
    return df.where(F.col(day_col).between(first, last))


def _is_corrupt(columns: Sequence[str]) -> Column:
    """Corrupt-row test that also reads the parsed fields.

    Spark refuses scans whose only required column is the corrupt-record
    column (e.g. ``bad.count()``), so the test is phrased over the fields
    too; it is true exactly when the corrupt-record column is set.
    """
    return _corrupt_probe(columns).isNotNull()


def _is_clean(columns: Sequence[str]) -> Column:
    """Negation of ``_is_corrupt``, phrased the same way for the same reason."""
    return _corrupt_probe(columns).isNull()


def _corrupt_probe(columns: Sequence[str]) -> Column:
    # Null exactly when the corrupt-record column is null (the other parts
    # are never null). It reads every declared field, so the parser always
    # tokenises whole rows: with column pruning a row with extra fields would
    # otherwise pass as clean when only some columns are selected.
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat(F.col(CORRUPT), *rest)


def _split_corrupt(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    # The quarantine keeps whatever fields did parse next to the raw text.
    good = df.where(_is_clean(columns)).select(*columns)
    bad = df.where(_is_corrupt(columns)).select(
        *columns, F.col(CORRUPT).alias("raw"), F.lit("malformed").alias("error"))
    return good, bad


def read_json_lines(spark: SparkSession, path, schema: T.StructType,
                    required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """SRC2/SRC3/SRC7: NDJSON with a declared schema.

    Lines that are not JSON objects go to the quarantine, and so do rows
    missing a required field (the reference job failed on those).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(full).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    missing = None
    for name in required:
        cond = F.col(name).isNull()
        missing = cond if missing is None else missing | cond
    cols = [f.name for f in schema.fields]
    if missing is None:
        return _split_corrupt(df, cols)
    good = df.where(_is_clean(cols) & ~missing).select(*cols)
    bad = df.where(_is_corrupt(cols) | missing).select(
        *cols, F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*cols))).alias("raw"),
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.lit("missing_field")).alias("error"),
    )
    return good, bad


def read_raw_json_lines(spark: SparkSession, path) -> DataFrame:
    """SRC8: one string column ``json`` per line; fields pulled at query time."""
    return spark.read.text(path).withColumnRenamed("value", "json")


def read_csv_exact(spark: SparkSession, path, schema: T.StructType, header: bool = True,
                   sep: str = ",", multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC4/SRC5/SRC6/SRC9: CSV or tab-separated text with an exact field count.

    The corrupt-record column catches rows with too few or too many fields
    (PERMISSIVE alone would pad or truncate them silently). One record per
    line is the default. With ``multi_line`` quoted newlines are part of a field
    (``read_quoted_records``). A large file is read by many tasks either way. Tab-separated text has no quoting; ``\\t``, ``\\n``,
    ``\\r`` and ``\\\\`` in a field are read back as ``sinks.write_tsv`` escapes them.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("enforceSchema", True))
    names = [f.name for f in schema.fields]
    if sep == "," and multi_line:
        return _split_corrupt(_parsed_records(read_quoted_records(spark, path), full, header), names)
    if sep == ",":
        return _split_corrupt(reader.schema(full).option("escape", '"').csv(path), names)
    # no quote and no escape character while splitting: fields are taken as they are
    good, bad = _split_corrupt(reader.schema(full).option("quote", "").option("escape", "\u0000").csv(path), names)
    text = {f.name: unescape_tsv(F.col(f.name)) for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return good.withColumns(text), bad


def unescape_tsv(c: Column) -> Column:
    """``\\t``, ``\\n``, ``\\r`` and ``\\\\`` back to the characters they stand for."""
    parts = F.split(c, r"\\\\", -1)  # an escaped backslash separates the rest
    plain = F.transform(parts, lambda p: F.replace(F.replace(F.replace(
        p, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(plain, "\\")).otherwise(c)


def read_timed_text(spark: SparkSession, paths_by_source: dict) -> tuple[DataFrame, DataFrame]:
    """SRC9: headerless ``time<TAB>content`` files, one per source, with a ``source`` column."""
    goods, bads = [], []
    for source, path in paths_by_source.items():
        good, bad = read_csv_exact(spark, path, schemas.TIMED_TEXT, header=False, sep="\t")
        goods.append(good.withColumn("source", F.lit(source)))
        bads.append(bad.withColumn("source", F.lit(source)))
    good, bad = goods[0], bads[0]
    for g, b in zip(goods[1:], bads[1:]):
        good, bad = good.unionByName(g), bad.unionByName(b)
    return good, bad


def register_table(df: DataFrame, name: str) -> DataFrame:
    """SRC6/SRC7: expose a declared-schema source to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def read_text_lines(spark: SparkSession, path, column: str = "text") -> DataFrame:
    """SRC10: one text per line, trimmed, blank lines skipped."""
    from threadsift.functions.text import trim_whitespace

    lines = spark.read.text(path).select(trim_whitespace("value").alias(column))
    return lines.where(F.col(column) != "")


def _placed_lines(lines: DataFrame, *columns: Column) -> DataFrame:
    """Lines with their file ``_path``, the start of their block in it ``_block``, and an order inside the block ``_at``."""
    return lines.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_at"), *columns)


def read_quoted_records(spark: SparkSession, path, quote: str = '"') -> DataFrame:
    """Records of text files whose quoted fields may hold newlines: ``_path, _record, record`` (numbered from 0 in each file).

    Files are split like any text. A line break ends a record where an even number of quotes stands
    before it in its file (a doubled quote counts twice, so quoted quotes do not matter). Quotes are counted
    per block, the parity is carried over the blocks of a file (a table with one row per block), and
    lines are then joined inside their block. Only records that reach into another block meet in a
    second, small shuffle. As RFC 4180 has it, a field that holds a quote must be quoted. Blank
    lines between records are left out; a carriage return before a line break belongs to the break only at the end of a record.
    """
    from pyspark.sql import Window

    lines = _placed_lines(spark.read.option("lineSep", "\n").text(path), F.col("value").alias("_line"))
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit(quote), F.lit("")))
    # one row per block: where it starts inside a quoted field, and how many records start before it
    inside = Window.partitionBy("_path", "_block").orderBy("_at")
    tagged = lines.withColumn("_odd", F.pmod(quotes, F.lit(2)))
    parity = F.pmod(F.sum("_odd").over(inside) - F.col("_odd"), F.lit(2))
    tagged = tagged.withColumn("_parity", parity)  # of the quotes before a line in its block
    blocks = tagged.groupBy("_path", "_block").agg(
        F.pmod(F.sum("_odd"), F.lit(2)).alias("_odd"), F.count_if(F.col("_parity") == 0).alias("_even"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_path").orderBy("_block")
    blocks = blocks.withColumn("_open", F.pmod(F.sum("_odd").over(earlier) - F.col("_odd"), F.lit(2)))
    starts = F.when(F.col("_open") == 0, F.col("_even")).otherwise(F.col("_n") - F.col("_even"))
    blocks = blocks.select("_path", "_block", "_open", starts.alias("_starts"), F.lead("_open", 1, 0).over(earlier).alias("_left_open"),
                           (F.sum(starts).over(earlier) - starts).alias("_before"))
    placed = tagged.join(blocks, ["_path", "_block"])
    begins = (F.col("_parity") == F.col("_open")).cast("bigint")
    numbered = placed.withColumn("_record", F.col("_before") + F.sum(begins).over(inside) - 1)
    parts = numbered.groupBy("_path", "_block", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_line"))), lambda x: x["_line"]), "\n").alias("_text"),
        F.any_value("_open").alias("_open"), F.any_value("_left_open").alias("_left_open"),
        F.any_value(F.col("_before") - 1).alias("_first"), F.any_value(F.col("_before") + F.col("_starts") - 1).alias("_last"))
    # the record before the block's first, and its last one if the next block starts inside quotes
    cut = ((F.col("_open") == 1) & (F.col("_record") == F.col("_first"))) | (
        (F.col("_left_open") == 1) & (F.col("_record") == F.col("_last")))
    joined = parts.where(cut).groupBy("_path", "_record").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_block", "_text"))), lambda x: x["_text"]), "\n").alias("_text"))
    records = parts.where(~cut).select("_path", "_record", "_text").unionByName(joined)
    return records.select("_path", "_record", F.regexp_replace("_text", r"\r\z", "").alias("record")).where(F.col("record") != "")


def _parsed_records(records: DataFrame, schema: T.StructType, header: bool, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of CSV records (and of the declared corrupt-record column); the first of a file is its header."""
    ddl = schema.toDDL()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true", "sep": ","}
    rows = records.where(F.col("_record") > 0) if header else records
    return rows.select(*keep, F.from_csv("record", ddl, options).alias("_csv")).select(*keep, "_csv.*")


def read_text_lines_indexed(spark: SparkSession, path, column: str = "text") -> DataFrame:
    """SRC10/SRC14 with a place: ``file`` (0 .. in the order of the paths) and ``pos``.

    ``pos`` counts the non-blank lines of a file. Every line is tagged with its
    file, the start of its block in the file and its order in the block;
    lines are ranked inside their own block (groups bounded by one block) and
    shifted by the number of non-blank lines in the file's earlier blocks (a
    table with one row per block). How blocks are packed into tasks does not
    matter.
    """
    from pyspark.sql import Window

    from threadsift.functions.text import trim_whitespace

    text = spark.read.text(path)
    raw = _placed_lines(text, trim_whitespace("value").alias(column))
    local = Window.partitionBy("_path", "_block").orderBy("_at")
    kept = raw.where(F.col(column) != "").withColumn("_r", F.row_number().over(local) - 1)
    # one row per block: the running sums run over that small table
    sizes = raw.groupBy("_path", "_block").agg(F.count_if(F.col(column) != "").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # the list of files, which the scan has too; empty ones count
    paths = sorted(re.sub("^file:/+", "file:/", f) for f in text.inputFiles())
    files = spark.createDataFrame(list(zip(paths, range(len(paths)))), "_path string, file int")
    offsets = sizes.select("_path", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")).join(files, "_path")
    numbered = kept.join(offsets, ["_path", "_block"])
    return numbered.select("file", (F.col("_off") + F.col("_r")).cast("bigint").alias("pos"), column)


def read_csv_with_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SRC11: a header CSV that must hold a ``text`` column (``multi_line`` as in ``read_csv_exact``)."""
    if not str(path).endswith((".csv", ".txt")) and not str(path).endswith("/"):
        raise ValueError("unsupported file type: use .txt or .csv")
    if str(path).endswith(".txt"):
        return read_text_lines(spark, path)
    df = spark.read.option("header", True).option("escape", '"').csv(path)  # reads the first line
    if "text" not in df.columns:
        raise ValueError("CSV file must contain a 'text' column")
    if multi_line:
        df = _parsed_records(read_quoted_records(spark, path), df.schema, header=True)
    return df.select("text")


def read_labelled(spark: SparkSession, rows) -> DataFrame:
    """SRC12: a (text, label) table from in-memory rows (fixtures only)."""
    return spark.createDataFrame(rows, schemas.LABELLED)


def read_corpus(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """SRC13: a public corpus already on storage as parquet."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
