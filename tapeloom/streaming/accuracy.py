"""How often forecasts were right, on a stream whose labels come later.

A scored trade meets the label of the bar it fell into by an interval join: a label is
known when the bar and the horizon behind it have passed, so both sides are kept for
that long and the watermark's delay, no longer. What counts is kept per bar, not per
trade: a micro-batch's trades are added up before the join. Every micro-batch adds its counts per
symbol and window; readers add them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timebucket import DAY_MS, floor_to, rule_ms
from ..sources import paths

# A forecast says up from this probability on.
THRESHOLD = 0.5


def judged(scored: DataFrame, labels: DataFrame, rule: str, horizon: int = 1, delay: str = "10 minutes") -> DataFrame:
    """(symbol, ts, prob_up, label, hit) of every scored trade whose label is known.

    `scored` has (symbol, ts, prob_up), `labels` (symbol, bucket, label) with the start
    of the bar in ms; each is a stream or a table. A label is known at the end of the
    bar `horizon` bars later. On streams, rows that come later than `delay` behind the
    newest of their side may find their partner gone; without a label there is no row.
    """
    guess = scored.select("symbol", "ts", "prob_up", floor_to(F.col("ts"), rule_ms(rule)).alias("bucket"), F.timestamp_millis("ts").alias("at"))
    hit = ((F.col("prob_up") >= THRESHOLD) == (F.col("label") == 1)).alias("hit")
    return _met(guess, labels, rule, horizon, delay).select("symbol", "ts", "prob_up", "label", hit)


def _met(guess: DataFrame, labels: DataFrame, rule: str, horizon: int, delay: str) -> DataFrame:
    """Rows (symbol, bucket, at, ...) with the label of their bar."""
    step = rule_ms(rule)
    if DAY_MS % step:
        raise ValueError(f"bars of {rule} don't lie on one grid for all symbols")
    span = step * (horizon + 1)
    told = labels.select(F.col("symbol").alias("label_symbol"), F.col("bucket").alias("label_bucket"), "label", F.timestamp_millis(F.col("bucket") + span).alias("known"))
    if guess.isStreaming:
        guess, told = guess.withWatermark("at", delay), told.withWatermark("known", delay)
    near = F.expr(f"known > at AND known <= at + INTERVAL '{span / 1000:.3f}' SECOND")
    same = (F.col("symbol") == F.col("label_symbol")) & (F.col("bucket") == F.col("label_bucket"))
    return guess.join(told, same & near)


def counted(hits: DataFrame, window_ms: int) -> DataFrame:
    """(symbol, window, n, hits): sums that may be added to others."""
    return hits.groupBy("symbol", floor_to(F.col("ts"), window_ms).alias("window")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("bigint")).alias("hits")
    )


#: Rows a task gathers before it adds them up.
GATHERED = 1 << 18

_TALLY = "symbol string, window bigint, bucket bigint, at timestamp, n bigint, up bigint, down bigint"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one symbol, window and bar added up, as far as a task holds them at once."""
    held: list[pa.RecordBatch] = []

    def added() -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        names = rows.schema.names
        total = rows.group_by(names[:3]).aggregate([("at", "max"), *((c, "sum") for c in names[4:])])
        return total.rename_columns(names).select(names).cast(rows.schema).combine_chunks().to_batches()

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= GATHERED:
            held = added()
            if sum(x.num_rows for x in held) >= GATHERED // 2:
                yield from held
                held = []
    if held:
        yield from added()


def tallied(scored: DataFrame, rule: str, window_ms: int) -> DataFrame:
    """(symbol, window, bucket, at, n, up, down): trades and forecasts either way, `at` the latest time.

    On a stream a micro-batch gives a row per window and bar, added up before and behind a
    shuffle. No state is needed for that, and a join keeps these rows instead of all trades.
    """
    up = F.col("prob_up") >= THRESHOLD
    rows = scored.where("symbol IS NOT NULL AND ts IS NOT NULL").select(
        F.col("symbol").cast("string").alias("symbol"), floor_to(F.col("ts"), window_ms).cast("bigint").alias("window"),
        floor_to(F.col("ts"), rule_ms(rule)).cast("bigint").alias("bucket"), F.timestamp_millis("ts").alias("at"),
        F.lit(1).cast("bigint").alias("n"), up.cast("bigint").alias("up"), (~up).cast("bigint").alias("down"),
    )
    return rows.mapInArrow(_summed, _TALLY).repartition("symbol", "window", "bucket").mapInArrow(_summed, _TALLY)


def met(scored: DataFrame, labels: DataFrame, rule: str, horizon: int = 1, window_ms: int = 3_600_000, delay: str = "10 minutes") -> DataFrame:
    """(symbol, window, n, hits) of the trades that `judged` would give, in parts to be added up.

    All trades of a bar meet the same labels, so bars meet them instead. A bar is as
    late as its latest trade in the micro-batch.
    """
    hits = F.when(F.col("label") == 1, F.col("up")).when(F.col("label") != 1, F.col("down"))
    return _met(tallied(scored, rule, window_ms), labels, rule, horizon, delay).select("symbol", "window", "n", hits.alias("hits"))


def start(
    scored: DataFrame,
    labels: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    rule: str,
    horizon: int = 1,
    window_ms: int = 3_600_000,
    delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Add the counts of every micro-batch to `out_path`, each batch once."""
    feed = paths.feed_id(scored.sparkSession, checkpoint)
    return (
        met(scored, labels, rule, horizon, window_ms, delay)
        .writeStream.queryName("accuracy")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, batch_id: paths.write_once(_totals(batch), out_path, feed, batch_id))
        .start()
    )


def _totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("symbol", "window").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def accuracy(parts: DataFrame) -> DataFrame:
    """(symbol, window, n, hits, accuracy) from counts, however many parts they come in."""
    return _totals(parts).withColumn("accuracy", F.col("hits") / F.col("n"))


def read(spark: SparkSession, out_path: str) -> DataFrame:
    """The accuracy so far, from the folder of a running or ended query."""
    schema = "symbol string, window bigint, n bigint, hits bigint"
    return accuracy(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out_path))
