"""What a running stream is doing: trades per second, and how late they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timebucket import floor_to
from ..operators import quantiles
from ..schema import with_symbol
from ..sources import paths

SECOND = 1000
# Units of time of a gap that are told together (2**12).
GAP_BITS = 12


def start_throughput(trades: DataFrame, out_path: str, checkpoint: str, *, delay: str = "1 minute", unit_ms: int = SECOND, trigger: dict | None = None) -> StreamingQuery:
    """Count trades per symbol and second (or other unit) of their time, as they come.

    Every micro-batch writes the new count of the seconds that it changed, once; the
    watermark bounds how long a second is kept, and trades that come later are left
    out. `observedMetrics` of the query's progress tell rows and newest time by batch.
    """
    feed = paths.feed_id(trades.sparkSession, checkpoint)
    seen = with_symbol(trades).where("ts IS NOT NULL").select("symbol", "ts", F.timestamp_millis("ts").alias("at"))
    seen = seen.observe("ticks", F.count(F.lit(1)).alias("rows"), F.max("ts").alias("newest"))
    counted = seen.withWatermark("at", delay).groupBy("symbol", F.window("at", f"{unit_ms} milliseconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select("symbol", F.unix_millis("w.start").alias("second"), "n")
    return (
        rows.writeStream.queryName("throughput")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, batch_id: paths.write_once(batch, out_path, feed, batch_id))
        .start()
    )


def per_unit(counts: DataFrame, unit_ms: int = SECOND) -> DataFrame:
    """(symbol, second, n) from written counts, the newest of each second, empty seconds as 0.

    From a symbol's first second to its last. A count only grows, so the newest is the
    greatest. Gaps are told in two steps, so that a long one is many tasks' work.
    """
    newest = counts.groupBy("symbol", "second").agg(F.max("n").alias("n"))
    ends = newest.groupBy("symbol").agg(F.min("second").alias("low"), F.max("second").alias("high"))
    width = unit_ms << GAP_BITS
    blocks = ends.withColumn("block", F.explode(F.sequence(floor_to(F.col("low"), width), F.col("high"), F.lit(width).cast("bigint"))))
    # Written in as many parts as there are blocks before each becomes many rows.
    blocks = blocks.repartition("symbol", "block")
    first, last = F.greatest("low", "block"), F.least("high", F.col("block") + width - unit_ms)
    every = blocks.select("symbol", F.explode(F.sequence(first, last, F.lit(unit_ms).cast("bigint"))).alias("second"))
    return every.join(newest, ["symbol", "second"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def read_throughput(spark: SparkSession, out_path: str, unit_ms: int = SECOND) -> DataFrame:
    schema = "symbol string, second bigint, n bigint"
    return per_unit(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out_path), unit_ms)


def start_latency(
    events: DataFrame, latency: Column, out_path: str, checkpoint: str, *, time: str = "ts", window_ms: int = 60_000, accuracy: float = quantiles.ACCURACY, trigger: dict | None = None
) -> StreamingQuery:
    """Sketch `latency` per window of `time`; every micro-batch writes the sketch of its own rows, once."""
    feed = paths.feed_id(events.sparkSession, checkpoint)
    slim = events.select(floor_to(F.col(time), window_ms).alias("window"), latency.cast("double").alias("latency"))
    return (
        slim.writeStream.queryName("latency")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, batch_id: paths.write_once(quantiles.sketch(batch, ["window"], "latency", accuracy), out_path, feed, batch_id))
        .start()
    )


def read_latency(spark: SparkSession, out_path: str, probabilities: Sequence[float] = quantiles.PROBABILITIES, accuracy: float = quantiles.ACCURACY) -> DataFrame:
    """(window, probability, value) over everything written so far."""
    parts = spark.read.schema("window bigint, bin int, n bigint").option("recursiveFileLookup", "true").parquet(out_path)
    return quantiles.estimated(quantiles.merged(parts, ["window"]), ["window"], probabilities, accuracy)
