"""Structured Streaming variants of the batch operators (§2.11 extensions).

The reference has no streaming operator; these reuse the same Column
expressions on an unbounded file source, so a directory that keeps
receiving files can be cleaned and counted incrementally:

* ``clean_stream``: a stateless cleaner (any of the Column cleaners);
* ``dedupe_stream``: first record per id within a watermark, with bounded
  state (``dropDuplicatesWithinWatermark``);
* ``windowed_word_counts``: hot-word counts per event-time window with a
  watermark, emitted once the window closes (append mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.operators.words import word_tokens


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream with a declared schema (no inference)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def clean_stream(stream: DataFrame, columns: dict) -> DataFrame:
    """Apply Column cleaners (name -> Column) to every micro-batch."""
    return stream.select(*[c.alias(n) for n, c in columns.items()])


def dedupe_stream(stream: DataFrame, key: Sequence[str], ts_col: str, delay: str = "1 hour") -> DataFrame:
    """A20 on a stream: drop repeats of a key seen within ``delay`` of event time."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(key))


def windowed_word_counts(stream: DataFrame, text_col: str, ts_col: str, keys: Sequence[str] = (),
                         window: str = "7 days", delay: str = "1 day") -> DataFrame:
    """A12 per event-time window: ``window, keys..., word, freq``."""
    tokens = word_tokens(stream, text_col, [ts_col, *keys])
    return (tokens.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window), *keys, "word")
            .agg(F.count(F.lit(1)).alias("freq")))
