"""Forward-return labels and the chronological split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F, types as T

from ..functions.timebucket import grid
from ..schema import with_symbol
from . import bars, ordered

DEFAULT_HORIZON = 1
DEFAULT_THRESHOLD = 0.001
TEST_SHARE = 0.2
TARGETS = ("label", "future_return")

# 2**28 ms, about three days of bars per chunk.
TIME_CHUNK_BITS = 28


def _targets(ahead: DataFrame, threshold: float, columns: list[str]) -> DataFrame:
    """Targets from ``price_close`` and ``price_ahead``."""
    close = F.col("price_close")
    change = F.col("price_ahead") - close
    beyond = F.when(change > 0, F.lit(float("inf"))).when(change < 0, F.lit(float("-inf")))
    future_return = F.when(close == 0, beyond).otherwise(change / F.nullif(close, F.lit(0.0)))
    return (
        ahead.withColumn("future_return", future_return)
        .where(F.col("future_return").isNotNull() & ~F.isnan("future_return"))
        .withColumn("label", F.when(F.col("future_return") >= threshold, 1).otherwise(0))
        .select(*columns, "future_return", "label")
    )


def labelled_bars(
    trades: DataFrame,
    rule: str = bars.DEFAULT_RULE,
    windows: Iterable[int] = bars.DEFAULT_WINDOWS,
    horizon: int = DEFAULT_HORIZON,
    threshold: float = DEFAULT_THRESHOLD,
    chunk_bars: int = bars.CHUNK_BARS,
) -> DataFrame:
    """Feature bars with their targets, straight from trades.

    The future price is looked up where the bars are made, in the same chunk,
    so labels cost no further shuffle whatever the horizon.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    ahead = bars.features(trades, rule, windows, chunk_bars, horizon)
    return _targets(ahead, threshold, [c for c in ahead.columns if c != "price_ahead"])


def chunk_bits_of(rule: str, horizon: int = DEFAULT_HORIZON) -> int:
    """Width of chunks of time that hold some thousand bars of a rule, and many horizons."""
    return (grid(rule).span * max(bars.CHUNK_BARS, 8 * horizon)).bit_length()


def build_targets(
    bars: DataFrame,
    horizon: int = DEFAULT_HORIZON,
    threshold: float = DEFAULT_THRESHOLD,
    *,
    chunk_bits: int = TIME_CHUNK_BITS,
) -> DataFrame:
    """Add ``future_return`` over ``horizon`` rows and the 0/1 ``label`` to made bars.

    ``labelled_bars`` makes both at once. ``chunk_bits_of`` tells chunks that suit the
    bars' rule; the default suits minutes. The last ``horizon`` bars of a symbol have no future and are dropped.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")

    def columns(frame: DataFrame, spec: WindowSpec) -> DataFrame:
        return frame.withColumn("price_ahead", F.lag("price_close", horizon).over(spec))

    timed = with_symbol(bars).withColumn("_at", F.unix_millis("timestamp"))
    ahead = ordered.framed(
        timed, ["symbol"], "_at", horizon, columns, descending=True, chunk_bits=chunk_bits, levels=1
    )
    return _targets(ahead, threshold, bars.columns)


def numeric_features(df: DataFrame) -> tuple[str, ...]:
    """Numeric columns in frame order, the targets left out."""
    return tuple(
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in TARGETS
    )


def chrono_split(
    dataset: DataFrame, test_share: float = TEST_SHARE, *, chunk_bits: int = TIME_CHUNK_BITS
) -> DataFrame:
    """Add ``is_test``: the last ``ceil(test_share * n)`` rows of each symbol.

    Only the chunk that holds the boundary is ranked; all other rows are
    compared with the time found there. The dataset is read three times, twice
    for its time column only, so pass a written one.
    """
    base = with_symbol(dataset).withColumns(
        {"_at": F.unix_millis("timestamp"), "_chunk": F.shiftright(F.unix_millis("timestamp"), chunk_bits)}
    )
    spec = Window.partitionBy("symbol").orderBy("_chunk")
    whole = Window.partitionBy("symbol")
    rows = F.sum("_n").over(whole)
    borders = (
        base.groupBy("symbol", "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns(
            {
                "_upto": F.sum("_n").over(spec),
                "_train": rows - F.ceil(F.lit(float(test_share)) * rows).cast("bigint"),
            }
        )
        .where((F.col("_upto") - F.col("_n") < F.col("_train")) & (F.col("_train") <= F.col("_upto")))
        .select("symbol", "_chunk", (F.col("_train") - (F.col("_upto") - F.col("_n"))).alias("_inside"))
    )
    in_time = Window.partitionBy("symbol").orderBy("_at")
    cuts = (
        base.select("symbol", "_chunk", "_at")
        .join(borders, ["symbol", "_chunk"])
        .withColumn("_rank", F.row_number().over(in_time))
        .where(F.col("_rank") == F.col("_inside"))
        .select("symbol", F.col("_at").alias("_last_train"))
    )
    joined = base.join(cuts, "symbol", "left")
    # No cut means every row of the symbol is a test row.
    is_test = F.coalesce(F.col("_at") > F.col("_last_train"), F.lit(True))
    return joined.withColumn("is_test", is_test).select(*dataset.columns, "is_test")
