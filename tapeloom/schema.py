"""Column contracts shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

# 2**18 ms, about four minutes of trades for a task to number.
ARRIVAL_BITS = 18

UNKNOWN_SYMBOL = "UNKNOWN"

# One raw exchange frame: the message text and its arrival position.
RAW_FRAME = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

# `seq` is the arrival position (log offset), unique per symbol. It turns the
# order of trades that share a millisecond into a fixed one.
TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("side", T.StringType()),
    ]
)


def with_symbol(df: DataFrame, default: str = UNKNOWN_SYMBOL) -> DataFrame:
    """Make the optional symbol column present and non-null."""
    if "symbol" in df.columns:
        return df.withColumn("symbol", F.coalesce(F.col("symbol"), F.lit(default)))
    return df.withColumn("symbol", F.lit(default))


def with_position(df: DataFrame) -> DataFrame:
    """Make the arrival position present; without one, ties have no order."""
    if "seq" in df.columns:
        return df.withColumn("seq", F.coalesce(F.col("seq"), F.lit(0).cast("bigint")))
    return df.withColumn("seq", F.lit(0).cast("bigint"))


def with_arrival(df: DataFrame) -> DataFrame:
    """Make the arrival position present for operators that go by it.

    Trades without one are taken in time order; at one time the order is price,
    quantity, side. The positions then are 1, 2, ... within each symbol. A
    millisecond is what one task numbers at least.
    """
    if "seq" in df.columns:
        return df
    from .operators import ordered

    timed = with_symbol(df).withColumn("_slot", F.shiftright("ts", ARRIVAL_BITS))
    before = ordered.offsets(timed, ["symbol"], "_slot", {"_before": F.lit(1).cast("bigint")})
    place = Window.partitionBy("symbol", "_slot").orderBy("ts", "price", "qty", "side")
    numbered = timed.withColumn("_place", F.row_number().over(place)).join(before, ["symbol", "_slot"])
    return numbered.withColumn("seq", F.col("_before") + F.col("_place")).drop("_slot", "_place", "_before")


def stamp_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """Overwrite the symbol of every row, as a single-pair build does."""
    return df.withColumn("symbol", F.lit(symbol))
