"""Access to the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Read one driver table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every driver table as a temporary view of the same name."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
