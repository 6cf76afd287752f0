"""Feature bars on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import paths


def save_features(bars: DataFrame, path: str) -> str:
    """Write bars, replacing what is there, and return the path."""
    bars.write.mode("overwrite").parquet(path)
    return path


def load_features(spark: SparkSession, path: str) -> DataFrame:
    paths.require(spark, path, "feature data")
    return spark.read.parquet(path)
