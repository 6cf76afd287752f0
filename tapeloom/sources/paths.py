"""What goes through the Hadoop file system, and dataset names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Readers skip folders whose names begin like this.
UNFINISHED = "_unfinished"


def _at(spark: SparkSession, path: str):
    """(file system, path) of the JVM; the only place that reaches for them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)


def write_once(df: DataFrame, base: str, feed: str, batch_id: int, kind: str = "parquet") -> None:
    """Write batch `batch_id` of a feed below ``base`` unless it is already there.

    The batch is written aside and appears under its name by one rename, so
    readers that tail ``base`` see it whole or not at all, and never change. What
    earlier attempts at the batch left aside is removed; one batch is written by
    one query at a time.
    """
    spark = df.sparkSession
    target = join(base, f"feed={feed}", f"batch={batch_id}")
    if exists(spark, target):
        return
    files, left = _at(spark, join(base, UNFINISHED, f"{feed}-{batch_id}-*"))
    for status in files.globStatus(left) or ():
        files.delete(status.getPath(), True)
    aside = join(base, UNFINISHED, f"{feed}-{batch_id}-{uuid.uuid4().hex}")
    df.write.format(kind).save(aside)
    files, source = _at(spark, aside)
    _, goal = _at(spark, target)
    files.mkdirs(goal.getParent())
    if not files.rename(source, goal):
        raise OSError(f"could not publish {target}")


def remembered(spark: SparkSession, checkpoint: str, name: str, value: str) -> str:
    """What the checkpoint holds under a name: the value of its first start."""
    path = join(checkpoint, name)
    if not exists(spark, join(path, "_SUCCESS")):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def feed_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the feed that a checkpoint belongs to, made with the checkpoint.

    Batch numbers start anew with every checkpoint, so only both together name a
    batch. The name lives in the checkpoint: a new or reset one is another feed.
    """
    return remembered(spark, checkpoint, "feed", uuid.uuid4().hex)


def require(spark: SparkSession, path: str, what: str) -> None:
    if not exists(spark, path):
        raise FileNotFoundError(f"{what} not found at {path}")


def join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def features_path(base: str, symbol: str, freq: str) -> str:
    return join(base, f"{symbol.lower()}_{freq}.parquet")


def model_path(base: str, symbol: str, freq: str, horizon: int) -> str:
    return join(base, f"{symbol.lower()}_{freq}_h{horizon}")
