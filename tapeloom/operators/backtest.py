"""What a strategy would have earned: equity and drawdown along each symbol's bars.

Equity is a running product, drawdown needs its running peak. Both are scans of an
associative state (product, peak, lowest, worst fall), so time is cut into chunks: each
chunk is scanned for itself, the states of the chunks before it are put together, and
the two meet. No symbol is one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import with_symbol

# 2**28 ms, about three days of bars for a task.
TIME_CHUNK_BITS = 28


def _finite(value: Column) -> Column:
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(usable, value).otherwise(0.0)


def strategy_returns(bars: DataFrame, position: Column, cost: float = 0.0, stake: float = 1.0) -> DataFrame:
    """Bars with `position` and `earned`, the strategy's return until the bar's horizon.

    `position` is what is held from the bar on, as a share of the stake (negative: sold
    short); `stake` is the share of the equity at risk and `cost` what a unit of position
    costs. A bar whose `future_return` is missing or infinite earns nothing.
    """
    held = F.coalesce(position.cast("double"), F.lit(0.0))
    earned = (held * _finite(F.col("future_return")) - F.abs(held) * cost) * stake
    return bars.withColumns({"position": held, "earned": F.coalesce(earned, F.lit(0.0))})


def equity(returns: DataFrame, *, chunk_bits: int = TIME_CHUNK_BITS) -> DataFrame:
    """`returns` with `equity` (1 before the first bar) and `drawdown` (0 at a peak, down to -1).

    By `timestamp`, unique per symbol. A loss of all there is leaves the equity at 0 or
    below and the drawdown at what it then is; a missing `earned` counts as 0.
    """
    own = list(with_symbol(returns).columns)
    grown = F.lit(1.0) + F.coalesce("earned", F.lit(0.0))
    timed = with_symbol(returns).withColumns({"_grown": grown, "_at": F.unix_millis("timestamp")})
    timed = timed.withColumn("_chunk", F.shiftright("_at", chunk_bits))
    inside = Window.partitionBy("symbol", "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    local = timed.withColumn("_product", F.product("_grown").over(inside)).withColumn("_peak", F.max("_product").over(inside))
    # A row per chunk: its product, and its peak as seen from its start.
    states = local.groupBy("symbol", "_chunk").agg(F.max_by("_product", "_at").alias("_whole"), F.max("_product").alias("_top"))
    before = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    states = states.withColumn("_start", F.coalesce(F.product("_whole").over(before), F.lit(1.0)))
    states = states.withColumn("_high", F.greatest(F.lit(1.0), F.coalesce(F.max(F.col("_start") * F.col("_top")).over(before), F.lit(1.0))))
    joined = local.join(states.select("symbol", "_chunk", "_start", "_high"), ["symbol", "_chunk"])
    now = F.col("_start") * F.col("_product")
    peak = F.greatest("_high", F.col("_start") * F.col("_peak"))
    return joined.withColumns({"equity": now, "drawdown": now / peak - 1}).select(*own, "equity", "drawdown")


def summary(curve: DataFrame) -> DataFrame:
    """(symbol, bars, trades, wins, final_equity, worst_drawdown) per symbol."""
    taken = F.col("position") != 0
    return curve.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if(taken).alias("trades"),
        F.count_if(taken & (F.col("earned") > 0)).alias("wins"),
        F.max_by("equity", "timestamp").alias("final_equity"),
        F.min("drawdown").alias("worst_drawdown"),
    )
