"""Landed raw frames, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..schema import RAW_FRAME, TRADE, UNKNOWN_SYMBOL


# Bits of a position that number the lines of a split.
SPLIT_BITS = 33
# Bits of a position that name the partition of a Kafka topic.
PARTITION_BITS = 14


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames landed with their arrival position, as Parquet ``[seq, value]``."""
    return spark.read.schema(RAW_FRAME).parquet(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files, one frame per line, in the order of file names and lines.

    Spark reads splits in any order, but the lines of one split in theirs: a
    split's place among the others goes in front of its lines' numbers. There is
    a row per split to put in order.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << SPLIT_BITS) - 1)).alias("_line"),
    )
    splits = lines.select("_file", "_start").distinct()
    placed = splits.withColumn("_place", F.row_number().over(Window.orderBy("_file", "_start")).cast("bigint") - 1)
    seq = F.shiftleft("_place", SPLIT_BITS).bitwiseOR(F.col("_line"))
    return lines.join(placed, ["_file", "_start"]).select("value", seq.alias("seq"))


def stream_frames(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_FRAME,
    *,
    max_bytes_per_trigger: int = 8 << 30,
    max_files_per_trigger: int | None = None,
    since_ms: int | None = None,
    **options: str,
) -> DataFrame:
    """Tail a folder of Parquet frames from its beginning.

    The position is kept in the checkpoint of the query that reads it. A
    micro-batch is capped by bytes, or by files where that is given.
    ``since_ms`` passes over files that were there before that time.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    frames = reader.parquet(path)
    if since_ms is None:
        return frames
    return frames.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since_ms)))


def stream_trades(spark: SparkSession, path: str, **options) -> DataFrame:
    """Tail the trade log written by the ingest stream."""
    return stream_frames(spark, path, TRADE, recursiveFileLookup="true", **options)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting: str = "earliest",
    max_offsets_per_trigger: int = 5_000_000,
) -> DataFrame:
    """Frames from a Kafka topic. Needs the Kafka connector on the class path.

    ``starting`` is ``earliest`` for the whole log or ``latest`` for new frames
    only; a restart goes on from the checkpoint.
    """
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )
    return kafka_frames(records)


def kafka_frames(records: DataFrame) -> DataFrame:
    """Frames ``[seq, value]`` of Kafka records.

    Offsets count per partition, so a position is the offset followed by the partition:
    no two records share one, and each partition keeps its order. Across partitions
    there is no order of arrival; records keyed by symbol have it per symbol. A record
    without a value is a frame without text, which is rejected with a reason.
    """
    seq = F.shiftleft("offset", PARTITION_BITS).bitwiseOR(F.col("partition").cast("bigint"))
    return records.select(seq.alias("seq"), F.col("value").cast("string").alias("value"))


def kafka_records(rows: DataFrame) -> DataFrame:
    """Rows as Kafka records, JSON values keyed by symbol so that its order is kept."""
    key = F.col("symbol") if "symbol" in rows.columns else F.lit(UNKNOWN_SYMBOL)
    value = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(key.alias("key"), value.alias("value"))
