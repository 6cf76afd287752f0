"""Raw frames to the trade log and the history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import normalize
from ..schema import TRADE, stamp_symbol, with_symbol
from ..sources import history, paths


def fan_out(
    frames: DataFrame,
    batch_id: int,
    log_path: str,
    history_path: str,
    rejects_path: str | None = None,
    symbol: str | None = None,
    *,
    drop_rejects: bool = False,
    feed: str = history.NO_FEED,
) -> None:
    """One micro-batch to the log, then to the history, each at most once.

    Without ``rejects_path`` a bad frame fails the batch before anything is
    written, unless ``drop_rejects`` asks to leave such frames out.
    """
    both = normalize.checked(frames).persist()
    try:
        rejects = normalize.rejects_of(both)
        if rejects_path:
            paths.write_once(rejects, rejects_path, feed, batch_id)
        elif not drop_rejects and (bad := rejects.first()) is not None:
            raise ValueError(f"bad trade message at {bad['seq']}: {bad['reason']}")
        trades = normalize.trades_of(both)
        trades = stamp_symbol(trades, symbol) if symbol else with_symbol(trades)
        trades = trades.select(*TRADE.names)
        paths.write_once(trades, log_path, feed, batch_id)
        history.append_batch(trades, history_path, batch_id, feed)
    finally:
        both.unpersist()


def start(
    frames: DataFrame,
    log_path: str,
    history_path: str,
    checkpoint: str,
    *,
    rejects_path: str | None = None,
    symbol: str | None = None,
    drop_rejects: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the fan-out on a stream of ``[seq, value]`` frames.

    Bad frames are kept under ``rejects_path`` together with the reason. Without
    it they fail the query, or go unseen if ``drop_rejects`` is set. Feeds may
    share the sinks: each batch is known by its checkpoint and number.
    """
    feed = paths.feed_id(frames.sparkSession, checkpoint)
    return (
        frames.writeStream.queryName("ingest")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(
            lambda batch, batch_id: fan_out(
                batch, batch_id, log_path, history_path, rejects_path, symbol, drop_rejects=drop_rejects, feed=feed
            )
        )
        .start()
    )


def append_log(trades: DataFrame, log_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream of trades to a Parquet log with the built-in file sink."""
    return (
        trades.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(log_path)
    )
