"""Driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Round-robin the rows when the scan yields fewer tasks than cores.

    Text jobs are CPU-bound per row; a file with one row group would run in a
    single task. On a cluster the scan already has far more splits than cores
    and this is a no-op (no extra shuffle).
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * per_core)
