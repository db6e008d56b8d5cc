"""Table helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.session import ensure_checkpoint_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; its lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def temporary_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def read(spark, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table, narrowed to ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into a new folder below the shared one, and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` whose hot keys adaptive execution can split.

    A side that was aggregated by the join keys keeps that partitioning, and then neither side of the join has an exchange
    that may be split. One more key, derived from the others, gives both sides exchanges of their own.
    """
    name = "join_part"
    while name in left.columns or name in right.columns:
        name = "_" + name
    part = F.pmod(F.xxhash64(*keys), F.lit(1 << 10)).cast("int")
    return left.withColumn(name, part).join(right.withColumn(name, part), [*keys, name], how).drop(name)
