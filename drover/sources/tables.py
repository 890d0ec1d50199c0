"""Scans of the day-partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def scan_days(spark: SparkSession, path: str, days=None) -> DataFrame:
    """Read a ``sim_day``-partitioned Parquet table, pruned to ``days`` (int or iterable)."""
    df = spark.read.parquet(path)
    if days is None:
        return df
    if isinstance(days, int):
        days = [days]
    return df.where(F.col("sim_day").isin([int(d) for d in days]))
