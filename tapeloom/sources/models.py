"""Fitted models with their metadata on disk."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession, functions as F

from ..operators.scoring import Bundle
from . import paths


def save_model(spark: SparkSession, bundle: Bundle, path: str, metadata: dict) -> str:
    """Write the model to a folder of its own, then a line of metadata that names it.

    Lines are only ever added and the newest counts, so a reader finds the old
    model with its columns or the new one with its own, at any time.
    """
    version = uuid.uuid4().hex
    bundle.model.write().save(paths.join(path, "versions", version))
    record = {**metadata, "feature_cols": list(bundle.feature_cols)}
    line = (time.time_ns(), version, json.dumps(record))
    one_row = spark.createDataFrame([line], "saved_at bigint, version string, metadata string").coalesce(1)
    one_row.write.mode("append").json(paths.join(path, "saved"))
    return path


def _newest(spark: SparkSession, path: str):
    lines = spark.read.schema("saved_at bigint, version string, metadata string").json(paths.join(path, "saved"))
    return lines.orderBy(F.col("saved_at").desc(), "version").first()


def load_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(_newest(spark, path)["metadata"])


def load_model(spark: SparkSession, path: str) -> Bundle | None:
    """The model saved last, or None where there is none yet."""
    newest = _newest(spark, path) if paths.exists(spark, paths.join(path, "saved")) else None
    if newest is None:
        return None
    cols = tuple(json.loads(newest["metadata"]).get("feature_cols", ()))
    return Bundle(PipelineModel.load(paths.join(path, "versions", newest["version"])), cols)
