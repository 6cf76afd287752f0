"""Scored trades as a stream of JSON texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import scoring
from ..sources import models, paths


def entries_of(trades: DataFrame) -> DataFrame:
    """Trades as score inputs: the position is the id, flow is not known yet."""
    return trades.select(
        F.col("seq").cast("string").alias("id"),
        F.coalesce("ts", F.lit(0).cast("bigint")).alias("ts"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("qty", F.lit(0.0)).alias("qty"),
        F.coalesce("side", F.lit("buy")).alias("side"),
        F.lit(0.0).alias("ofi"),
    )


def start(
    entries: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    model_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score every entry; JSON texts go to ``out_path``.

    Without ``model_path`` the query is a stateless projection. With it, each
    micro-batch uses the model found there at that time, or the rule if none.
    """
    when = trigger or {"availableNow": True}
    if model_path is None:
        texts = scoring.payload_json(scoring.payload(entries))
        writer = texts.writeStream.format("text").outputMode("append").trigger(**when)
        return writer.option("checkpointLocation", checkpoint).start(out_path)

    feed = paths.feed_id(entries.sparkSession, checkpoint)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        bundle = models.load_model(batch.sparkSession, model_path)
        texts = scoring.payload_json(scoring.payload(batch, bundle))
        paths.write_once(texts, out_path, feed, batch_id, "text")

    writer = entries.writeStream.trigger(**when).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(score_batch).start()
