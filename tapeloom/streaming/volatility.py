"""Rolling volatility of bars on a live stream, as they close.

Trades are summed up to bars by an event-time window, in parallel and map-side first;
the watermark closes the bars in order. Only closed bars, one row each, go on to the
state of their symbol, which holds the last close and the last returns.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.numbers import nan_to_null
from ..functions.timebucket import DAY_MS, rule_ms
from ..operators.bars import DEFAULT_WINDOWS
from ..schema import with_position, with_symbol

# Bars of a gap that are told at once.
GAP_BARS = 1 << 16

# The processor goes to workers as code, so they need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def closed_bars(trades: DataFrame, rule: str, delay: str) -> DataFrame:
    """(symbol, bucket, price_close) of bars with a trade, once the watermark has passed their end.

    Trades without a price are in no bar; trades older than the watermark are dropped.
    """
    step = rule_ms(rule)
    if DAY_MS % step:
        raise ValueError(f"bars of {rule} don't lie on one grid for all symbols")
    ticks = with_position(with_symbol(trades)).withColumn("price", nan_to_null(F.col("price").cast("double")))
    ticks = ticks.where("price IS NOT NULL AND ts IS NOT NULL").withColumn("at", F.timestamp_millis("ts"))
    if ticks.isStreaming:
        ticks = ticks.withWatermark("at", delay)
    bucket = F.window("at", f"{step} milliseconds").alias("bar")
    close = F.max_by("price", F.struct("ts", "seq")).alias("price_close")
    return ticks.groupBy("symbol", bucket).agg(close).select("symbol", F.unix_millis("bar.start").alias("bucket"), "price_close")


def _deviations(returns: np.ndarray, fresh: int, windows: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Sample deviations over the last w returns, for the last `fresh` of them; infinite ones are left out."""
    known = np.where(np.isfinite(returns), returns, np.nan)
    out = {}
    for w in windows:
        padded = np.concatenate([np.full(max(0, w - 1), np.nan), known])
        view = np.lib.stride_tricks.sliding_window_view(padded, w)[-fresh:]
        count = np.count_nonzero(~np.isnan(view), axis=1)
        mean = np.nansum(view, axis=1) / np.maximum(count, 1)
        square = np.nansum((view - mean[:, None]) ** 2, axis=1)
        out[f"vol_{w}"] = np.where(count > 1, np.sqrt(square / np.maximum(count - 1, 1)), 0.0)
    return out


def _returns(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Relative changes; infinite after zero, 0 from zero to zero."""
    safe = np.where(before == 0, 1.0, before)
    return np.where(before == 0, np.where(now == 0, 0.0, np.sign(now) * np.inf), now / safe - 1)


class _Volatility(StatefulProcessor):
    """State of a symbol: the start and close of its newest bar, and as many returns as the widest window needs."""

    def __init__(self, step: int, windows: tuple[int, ...]):
        self.step, self.windows, self.keep = step, windows, max(windows, default=1) - 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "last bigint, close double, past array<double>")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, close, past = self.newest.get() if self.newest.exists() else (None, None, [])
        past = np.array(past, float)
        # A row per closed bar of one symbol in a micro-batch.
        bars = pd.concat(list(rows)).sort_values("bucket")
        bucket, price = bars["bucket"].to_numpy(np.int64), bars["price_close"].to_numpy(float)
        first = last is None
        known = np.concatenate([[bucket[0] - self.step if first else last], bucket])
        closes = np.concatenate([[price[0] if first else close], price])
        # Bar i ends the run of grid points that begins behind the bar before it.
        ends = np.cumsum(np.diff(known) // self.step)
        for begin in range(0, int(ends[-1]), GAP_BARS):
            at = np.arange(begin, min(begin + GAP_BARS, int(ends[-1])))
            bar = np.searchsorted(ends, at, "right")
            left = ends[bar] - 1 - at
            now = np.where(left == 0, closes[bar + 1], closes[bar])
            fresh = _returns(closes[bar], now)
            every = np.concatenate([past, fresh])
            deviations = _deviations(every, len(fresh), self.windows)
            yield pd.DataFrame({"symbol": key[0], "bucket": bucket[bar] - self.step * left, "price_close": now, "return_1": fresh, **deviations})
            past = every[len(every) - self.keep :] if self.keep else every[:0]
        self.newest.update((int(bucket[-1]), float(price[-1]), past.tolist()))


def volatility(trades: DataFrame, rule: str, windows: Iterable[int] = DEFAULT_WINDOWS, delay: str = "10 minutes") -> DataFrame:
    """(symbol, bucket, price_close, return_1, vol_w ...) of every closed bar of a stream of trades.

    Bars between two trades repeat the last close, with a return of 0, as in
    `bars.compute`; a symbol's bars end with its newest closed bar that has a trade.
    """
    step = rule_ms(rule)
    windows = tuple(dict.fromkeys(int(w) for w in windows))
    if any(w < 1 for w in windows):
        raise ValueError("rolling windows must be at least 1")
    doubles = ["price_close", "return_1", *[f"vol_{w}" for w in windows]]
    out = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("bucket", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in doubles]])
    by_symbol = closed_bars(trades, rule, delay).groupBy("symbol")
    return by_symbol.transformWithStateInPandas(
        statefulProcessor=_Volatility(step, windows), outputStructType=out, outputMode="append", timeMode="none"
    )


def start(
    trades: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    rule: str,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the volatility of closed bars to Parquet files."""
    return (
        volatility(trades, rule, windows, delay)
        .writeStream.queryName("volatility")
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(out_path)
    )
