"""Correlations of symbols' returns per window of time, by blocks of symbol pairs.

Symbols are dealt into blocks; a task gets one window of two blocks, as a matrix of
bars by symbols, and sums the co-moments of all its pairs by matrix products. So the
width of a frame doesn't grow with the symbols, and a task's size is set by the block
and the window, not by the market.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timebucket import floor_to
from ..schema import with_symbol

# Symbols of a block.
BLOCK = 64

_PAIRS = "window bigint, symbol string, other string, n bigint, correlation double"


def _moments(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known = np.isfinite(values)
    return np.where(known, values, 0.0), known.astype(float), known


def pairs_of(frame: pd.DataFrame, window: int) -> Iterator[pd.DataFrame]:
    """Correlations between the symbols of two blocks in one window."""
    ones, others = (sorted(frame.loc[frame["side"] == side, "symbol"].unique()) for side in (0, 1))
    if not ones or not others:
        return
    times = np.unique(frame["bucket"].to_numpy())
    grids = []
    for side, names in ((0, ones), (1, others)):
        own = frame[frame["side"] == side]
        grid = np.full((len(times), len(names)), np.nan)
        grid[np.searchsorted(times, own["bucket"]), np.searchsorted(names, own["symbol"])] = own["value"]
        # Around the symbol's mean, so that sums of squares lose no digits.
        known = np.isfinite(grid)
        mean = np.where(known, grid, 0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
        grids.append((np.where(known, grid - mean, 0.0), known.astype(float)))
    (x, kx), (y, ky) = grids
    n = kx.T @ ky
    sx, sy = x.T @ ky, kx.T @ y
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = x.T @ y - sx * sy / n
        vx, vy = (x * x).T @ ky - sx * sx / n, kx.T @ (y * y) - sy * sy / n
        told = cov / np.sqrt(vx * vy)
    told = np.where((n > 1) & (vx > 1e-18) & (vy > 1e-18), np.clip(told, -1, 1), np.nan)
    a, b = np.nonzero((np.array(ones)[:, None] < np.array(others)[None, :]) & (n > 0))
    value = told[a, b]
    left, right = np.array(ones, object)[a], np.array(others, object)[b]
    yield pd.DataFrame({"window": window, "symbol": pd.Series(left, dtype=object), "other": pd.Series(right, dtype=object), "n": n[a, b].astype(int), "correlation": pd.array(value, dtype="Float64")})


def correlations(bars: DataFrame, window_ms: int, value: str = "return_1", block: int = BLOCK) -> DataFrame:
    """(window, symbol, other, n, correlation) for symbol < other that share a bar in the window.

    Over the bars both have a finite value for; NULL where there are fewer than two or
    one of them doesn't change. One row per symbol and `timestamp`.
    """
    slim = with_symbol(bars).select("symbol", F.unix_millis("timestamp").alias("bucket"), F.col(value).cast("double").alias("value"))
    slim = slim.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))
    # A row per symbol, in order of names; neighbours share a block.
    names = slim.select("symbol").distinct().withColumn("_block", F.floor((F.row_number().over(Window.orderBy("symbol")) - 1) / block))
    blocks = names.agg(F.max("_block")).first()[0]
    if blocks is None:
        return bars.sparkSession.createDataFrame([], _PAIRS)
    # Of two blocks the symbols of the lower one are on the left; of one block on both sides.
    lower = F.transform(F.sequence(F.col("_block"), F.lit(blocks)), lambda o: F.struct(F.col("_block").alias("one"), o.alias("two"), F.lit(0).alias("side")))
    upper = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_block")), lambda o: F.struct(o.alias("one"), F.col("_block").alias("two"), F.lit(1).alias("side")))
    placed = slim.join(names, "symbol").withColumn("window", floor_to(F.col("bucket"), window_ms))
    spread = placed.select("symbol", "bucket", "value", "window", F.inline(F.concat(lower, upper)))

    def task(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        made = list(pairs_of(frame, key[0]))
        return made[0] if made and len(made[0]) else pd.DataFrame(columns=["window", "symbol", "other", "n", "correlation"], dtype=object)

    return spread.groupBy("window", "one", "two").applyInPandas(task, _PAIRS)
