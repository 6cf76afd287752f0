"""Order-flow imbalance on a stream of trades.

Frames of a row count are not allowed on streams. ``start`` keeps the last
trades of every symbol beside the checkpoint and runs the batch operator over
them and the new trades, so a busy symbol spreads over many tasks within each
micro-batch. ``start_stateful`` keeps them in the state store instead, for
many symbols that are all quiet.

Both need arrival positions that rise from one micro-batch to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import ordered
from ..operators.orderflow import OFI_TRADES, imbalance, side_sign
from ..schema import with_symbol
from ..sources import paths
from ..sources.history import NO_FEED


# Bytes per micro-batch that one task can take in the stateful form.
STATEFUL_BYTES = 128 << 20


def micro_batch(
    trades: DataFrame,
    batch_id: int,
    out_path: str,
    state_path: str,
    size: int = OFI_TRADES,
    feed: str = NO_FEED,
) -> None:
    """Features of one micro-batch, and the last ``size - 1`` trades per symbol.

    The output is written once per feed and batch; the state belongs to one
    checkpoint and is named by batch, so a repeated batch replaces its own.
    """
    spark = trades.sparkSession

    def state(batch: int) -> str:
        return paths.join(state_path, f"batch={batch}")

    fresh = with_symbol(trades).select("symbol", "seq", "ts", "side", F.lit(True).alias("fresh")).persist()
    try:
        known = fresh
        if batch_id > 0:
            paths.require(spark, paths.join(state(batch_id - 1), "_SUCCESS"), "order-flow state")
            before = spark.read.schema("symbol string, seq bigint, ts bigint, side string").parquet(state(batch_id - 1))
            known = fresh.unionByName(before.withColumn("fresh", F.lit(False)))
        paths.write_once(imbalance(known, size, emit="fresh"), out_path, feed, batch_id)
        last = ordered.latest_rows(known, ["symbol"], "seq", size - 1).drop("fresh")
        last.write.mode("overwrite").parquet(state(batch_id))
    finally:
        fresh.unpersist()
    if batch_id > 1:
        paths.remove(spark, state(batch_id - 2))


def start(
    trades: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    size: int = OFI_TRADES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write one feature row per trade to ``out_path/feed=ID/batch=N``."""
    state_path = paths.join(checkpoint, "last_trades")
    feed = paths.feed_id(trades.sparkSession, checkpoint)
    return (
        trades.writeStream.queryName("orderflow")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, batch_id: micro_batch(batch, batch_id, out_path, state_path, size, feed))
        .start()
    )


def _sliding(signs: np.ndarray, context: int, size: int) -> np.ndarray:
    """OFI of ``signs[context:]``, each over its last ``size`` entries."""
    net = np.concatenate(([0], np.cumsum(signs)))
    known = np.concatenate(([0], np.cumsum(np.abs(signs))))
    end = np.arange(context, len(signs)) + 1
    begin = np.maximum(end - size, 0)
    return (net[end] - net[begin]) / np.maximum(known[end] - known[begin], 1)


def stateful(trades: DataFrame, size: int = OFI_TRADES) -> DataFrame:
    """Stream of features from per-symbol state.

    All trades of a symbol in a micro-batch meet in one task, so cap the
    source's micro-batches at what one task may hold (``STATEFUL_BYTES`` for
    files, offsets per trigger for Kafka); the next micro-batch goes on from
    the state.
    """

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(frames)).sort_values("seq")
        past = np.array(state.get[0] if state.exists else [], dtype=np.int64)
        signs = np.concatenate((past, batch["sign"].to_numpy(dtype=np.int64)))
        keep = signs[-(size - 1):] if size > 1 else signs[:0]
        state.update((keep.tolist(),))
        yield pd.DataFrame(
            {
                "symbol": key[0],
                "seq": batch["seq"].to_numpy(),
                "ts": batch["ts"].to_numpy(),
                "ofi": _sliding(signs, len(past), size),
            }
        )

    slim = with_symbol(trades).select("symbol", "seq", "ts", side_sign(F.col("side")).alias("sign"))
    return slim.groupBy("symbol").applyInPandasWithState(
        advance,
        "symbol string, seq bigint, ts bigint, ofi double",
        "signs array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def start_stateful(
    trades: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    size: int = OFI_TRADES,
    trigger: dict | None = None,
) -> StreamingQuery:
    return (
        stateful(trades, size)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(out_path)
    )
