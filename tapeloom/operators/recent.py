"""Views of the newest trades, and portfolio totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import dollars, fixed, signed_percent
from ..functions.timebucket import slot_of, utc_clock
from ..schema import with_arrival, with_symbol
from . import ordered

BUFFER_TRADES = 200
FEED_TRADES = 30
ABSENT = "—"

# Milliseconds per chunk of the axis (2**20, about 17 minutes).
AXIS_CHUNK_BITS = 20


def last_trades(trades: DataFrame, count: int = BUFFER_TRADES) -> DataFrame:
    """The newest ``count`` trades per symbol by arrival."""
    return ordered.latest_rows(with_arrival(with_symbol(trades)), ["symbol"], "seq", count)


def latest_trade(trades: DataFrame) -> DataFrame:
    return last_trades(trades, 1)


def summary(trades: DataFrame, count: int = BUFFER_TRADES) -> DataFrame:
    """Last price and percent change from first to last buffered trade.

    The change is 0 where the first price is 0.
    """
    first, last = F.col("first_price"), F.col("last_price")
    change = F.when(first == 0, F.lit(0.0)).otherwise((last - first) / F.nullif(first, F.lit(0.0)) * 100)
    return (
        last_trades(trades, count)
        .groupBy("symbol")
        .agg(F.min_by("price", "seq").alias("first_price"), F.max_by("price", "seq").alias("last_price"))
        .select("symbol", "last_price", change.alias("change_pct"))
    )


def ticker(summaries: DataFrame) -> DataFrame:
    """Display text of price and change; a dash where there is no price."""
    price = F.col("last_price")
    return summaries.select(
        "symbol",
        F.coalesce(dollars(price, 2), F.lit(ABSENT)).alias("price_text"),
        F.when(price.isNull(), F.lit(ABSENT)).otherwise(signed_percent(F.col("change_pct"))).alias("change_text"),
    )


def trade_feed(trades: DataFrame, count: int = FEED_TRADES) -> DataFrame:
    """The newest trades per symbol with display text; ``position`` 1 is newest."""
    newest = Window.partitionBy("symbol").orderBy(F.col("seq").desc())
    return last_trades(trades, count).select(
        "symbol",
        F.row_number().over(newest).alias("position"),
        "seq",
        utc_clock(F.col("ts")).alias("time_text"),
        dollars(F.col("price"), 3).alias("price_text"),
        fixed(F.col("qty"), 6).alias("qty_text"),
        "side",
    )


def _chunk_starts(chunks: DataFrame) -> DataFrame:
    """Per chunk: trades before it, and how far the axis ran ahead of them."""
    zero = F.lit(0).cast("bigint")
    earlier = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), zero)).select(
        "symbol",
        "_chunk",
        "_start",
        F.greatest(zero, F.max(F.col("_top") - F.col("_start")).over(earlier)).alias("_ahead"),
    )


def monotone_axis(
    trades: DataFrame, *, chunk_bits: int = AXIS_CHUNK_BITS, seq_bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """Strictly rising whole seconds ``axis`` per symbol in ``(ts, seq)`` order.

    A trade takes its own second, or one more than the trade before it if that
    is not larger: ``axis = n + max(0, max over trades up to it of (second - n))``
    with ``n`` the trade's number. Numbers come from counts per millisecond and
    run of arrival positions, summed map-side: running counts within stretches
    of time, stretches chained by their totals. Within a run the first trade has
    the largest ``second - n``. So trades move once, to be numbered inside their
    run, and even a single busy millisecond is shared.
    """
    key = ["symbol", "_chunk"]
    run = [*key, "ts", "_run"]
    slim = with_arrival(with_symbol(trades)).select(
        "symbol",
        "seq",
        "ts",
        "price",
        F.shiftright(F.col("ts"), chunk_bits).alias("_chunk"),
        F.shiftright(F.col("seq"), seq_bits).alias("_run"),
    )
    second = slot_of(F.col("ts"), 1000)
    in_runs = Window.partitionBy(*key).orderBy("ts", "_run")
    before = F.sum("_n").over(in_runs.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        slim.groupBy(*run)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(before, F.lit(0).cast("bigint")))
        .withColumn(
            "_top",
            F.max(second - F.col("_before") - 1).over(in_runs.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    starts = _chunk_starts(runs.groupBy(*key).agg(F.sum("_n").alias("_rows"), F.max("_top").alias("_top")))
    placed = runs.join(starts, key).drop("_n")
    in_run = Window.partitionBy(*run).orderBy("seq")
    numbered = slim.withColumn("_nth", F.row_number().over(in_run)).join(placed, run)
    nth = F.col("_before") + F.col("_nth")
    axis = F.col("_start") + nth + F.greatest(F.col("_ahead"), F.col("_top") - F.col("_start"))
    return numbered.select("symbol", "seq", "ts", axis.alias("axis"), "price")


def chart_points(trades: DataFrame, count: int = BUFFER_TRADES) -> DataFrame:
    """The axis over the buffered trades only, as a live chart shows it."""
    return monotone_axis(last_trades(trades, count))


def portfolio_total(positions: DataFrame) -> DataFrame:
    """Total value of all positions, 0 for none."""
    return positions.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_value"))


def portfolio_lines(positions: DataFrame) -> DataFrame:
    """Display text per holding."""
    quantity: Column = F.col("quantity")
    return positions.select("symbol", quantity, "value", dollars(F.col("value"), 3).alias("value_text"))
