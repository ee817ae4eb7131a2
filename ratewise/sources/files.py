"""Parquet scans and Parquet / CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def load_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of the listed columns only (pruned at the reader)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Overwrite as Parquet; files are written by all tasks in parallel (no single-file funnel)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite as CSV with a header line per part file, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)
