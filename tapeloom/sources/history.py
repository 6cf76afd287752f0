"""The trade history: an append-only Parquet table by symbol, UTC day and batch."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.numbers import float_text
from ..functions.timebucket import utc_date
from ..operators import ordered
from ..schema import ARRIVAL_BITS, TRADE, with_arrival, with_position, with_symbol
from . import paths

PARTITIONS = ("symbol", "trade_date", "ingest_batch")
HISTORY = T.StructType(
    [
        *TRADE.fields[1:],
        TRADE["symbol"],
        T.StructField("trade_date", T.DateType()),
        T.StructField("ingest_batch", T.StringType()),
    ]
)
# Feed of rows that came from no stream.
NO_FEED = "direct"
# One file holds at most this many positions of a symbol and day (2**22).
FILE_BITS = 22
# The run of trades without a position, the first of their millisecond.
NO_RUN = -(1 << 63)


def create_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the history table if it is missing."""
    at = f" LOCATION '{location}'" if location else ""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) "
        f"USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}){at}"
    )


def _laid_out(trades: DataFrame, batch: str = NO_FEED) -> DataFrame:
    """Rows grouped for writing; a busy symbol and day spreads over many tasks."""
    dated = with_position(with_symbol(trades)).withColumns(
        {
            "trade_date": utc_date(F.col("ts")),
            "ingest_batch": F.lit(batch),
            "_file": F.shiftright("seq", FILE_BITS),
        }
    )
    return (
        dated.repartition("symbol", "trade_date", "_file")
        .sortWithinPartitions("symbol", "trade_date", "ts", "seq")
        .select(*HISTORY.names)
    )


def append(trades: DataFrame, path: str) -> None:
    """Add trades to the history; nothing is deduplicated."""
    _laid_out(trades).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def append_table(trades: DataFrame, name: str) -> None:
    """Add trades to the catalogued history table."""
    _laid_out(trades).write.mode("append").insertInto(name)


def append_batch(trades: DataFrame, path: str, batch_id: int, feed: str = NO_FEED) -> None:
    """Add a micro-batch; writing the same batch of the same feed again replaces it."""
    (
        _laid_out(trades, f"{feed}-{batch_id}")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def open_history(spark: SparkSession, path: str) -> DataFrame:
    """The history frame; fails if there is none. Other layouts keep their own columns."""
    paths.require(spark, path, "trade history")
    found = spark.read.parquet(path)
    if set(PARTITIONS) <= set(found.columns):
        # Folder names would otherwise decide the types (symbol 007 as a number).
        return spark.read.schema(HISTORY).parquet(path)
    return found


def select_trades(
    trades: DataFrame, symbol: str | None = None, start_ts: int | None = None, end_ts: int | None = None
) -> DataFrame:
    """Trades of a symbol with ``start_ts <= ts <= end_ts``.

    Either bound may be absent. The symbol is ignored where the frame has no
    such column. Days are bounded too where the frame has them, so whole
    partitions are skipped.
    """
    dated = "trade_date" in trades.columns

    def day(ms: int) -> Column:
        return utc_date(F.lit(ms).cast("bigint"))

    wanted: list[Column] = []
    if symbol is not None and "symbol" in trades.columns:
        wanted.append(F.col("symbol") == symbol)
    if start_ts is not None:
        wanted.append(F.col("ts") >= start_ts)
        if dated:
            wanted.append(F.col("trade_date") >= day(start_ts))
    if end_ts is not None:
        wanted.append(F.col("ts") <= end_ts)
        if dated:
            wanted.append(F.col("trade_date") <= day(end_ts))
    kept = trades.where(reduce(and_, wanted)) if wanted else trades
    columns = [c for c in ("seq", "ts", "price", "qty", "side", "symbol") if c in trades.columns]
    return kept.select(*columns)


def load_trades(
    spark: SparkSession,
    path: str,
    symbol: str | None = None,
    start_ts: int | None = None,
    end_ts: int | None = None,
    *,
    ordered: bool = False,
) -> DataFrame:
    """Bounded history load. Operators sort for themselves; ask for the order
    only where the rows leave the engine."""
    trades = select_trades(open_history(spark, path), symbol, start_ts, end_ts)
    return _in_order(trades) if ordered else trades


def _in_order(trades: DataFrame) -> DataFrame:
    return trades.orderBy(*[c for c in ("ts", "seq") if c in trades.columns])


def replay_range(
    trades: DataFrame, start_ts: int, end_ts: int, *, chunk_bits: int = ARRIVAL_BITS, seq_bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """Trades with ``ts`` in the closed range, in replay order, with ``position`` 1, 2, ...

    The order is ``(ts, seq, symbol)``. Positions come from counts per millisecond and
    run of arrival positions, summed map-side: running counts within stretches of
    time, stretches chained by their totals. A task ranks the trades of one run, so
    even a single busy millisecond is shared.
    """
    chosen = select_trades(with_arrival(trades), None, start_ts, end_ts)
    run = ["_slot", "ts", "_run"]
    timed = chosen.withColumns({"_slot": F.shiftright("ts", chunk_bits), "_run": F.coalesce(F.shiftright("seq", seq_bits), F.lit(NO_RUN))})
    before = Window.partitionBy("_slot").orderBy("ts", "_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = timed.groupBy(*run).agg(F.count(F.lit(1)).alias("_n"))
    starts = ordered.offsets(runs, [], "_slot", {"_ahead": F.col("_n")})
    within = F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint"))
    placed = runs.withColumn("_before", within).join(starts, "_slot").select(*run, (F.col("_ahead") + F.col("_before")).alias("_before"))
    last = ["symbol"] if "symbol" in chosen.columns else []
    place = Window.partitionBy(*run).orderBy("seq", *last)
    numbered = timed.withColumn("_place", F.row_number().over(place)).join(placed, run)
    return numbered.select(*chosen.columns, (F.col("_before") + F.col("_place")).alias("position")).orderBy("position")


def replay_entries(trades: DataFrame) -> DataFrame:
    """Trades as log entries, every value as text."""
    keep = [c for c in ("symbol", "seq", "position") if c in trades.columns]
    return trades.select(
        *keep,
        F.col("ts").cast("bigint").cast("string").alias("ts"),
        float_text(F.col("price").cast("double")).alias("price"),
        float_text(F.col("qty").cast("double")).alias("qty"),
        "side",
    )
