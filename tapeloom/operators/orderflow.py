"""Order-flow imbalance over the last trades of a symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..schema import with_arrival, with_symbol
from . import ordered

OFI_TRADES = 100


def side_sign(side: Column) -> Column:
    """+1 buy, -1 sell, 0 for any other value, which fills a slot only."""
    return F.when(side == "buy", 1).when(side == "sell", -1).otherwise(0).cast("bigint")


def ratio(net: Column, known: Column) -> Column:
    """(buys - sells) / (buys + sells) with 1 for an empty denominator."""
    return net.cast("double") / F.greatest(known, F.lit(1).cast("bigint")).cast("double")


def _ratio_of_running(counted: DataFrame, spec: WindowSpec, size: int) -> DataFrame:
    """``ofi`` from the running sums of the last ``size`` rows' end and start."""
    last = {c: F.col(c) - F.coalesce(F.lag(c, size).over(spec), F.lit(0).cast("bigint")) for c in ("_net", "_known")}
    return counted.withColumn("ofi", ratio(last["_net"], last["_known"])).drop("_net", "_known")


def imbalance_by_chunks(
    trades: DataFrame, size: int = OFI_TRADES, *, emit: str | None = None, chunk_bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """The values of ``imbalance`` with one shuffle of the ticks, but two sorts.

    For positions without wide holes.
    """
    sums = {"_net": F.col("_sign"), "_known": F.abs(F.col("_sign"))}

    def columns(ticks: DataFrame, spec: WindowSpec) -> DataFrame:
        # Running sums and their lag cost the same for any size; a sliding
        # frame would add up `size` rows per trade.
        upto = spec.rowsBetween(Window.unboundedPreceding, 0)
        return _ratio_of_running(ticks.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()}), spec, size)

    slim = with_arrival(with_symbol(trades)).select(
        "symbol", "seq", "ts", side_sign(F.col("side")).alias("_sign"), *([emit] if emit else [])
    )
    framed = ordered.framed(slim, ["symbol"], "seq", size - 1, columns, emit=emit, chunk_bits=chunk_bits)
    return framed.select("symbol", "seq", "ts", "ofi")


def imbalance(
    trades: DataFrame, size: int = OFI_TRADES, *, emit: str | None = None, chunk_bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """One ``ofi`` per trade over the last ``size`` trades, itself included.

    Counts rows in arrival order, not time. Rows are numbered by running counts
    and cut into blocks of equal size, so it does not matter how far apart the
    arrival positions of a symbol are. Rows whose ``emit`` column is false only
    serve as context.
    """
    slim = with_arrival(with_symbol(trades)).select(
        "symbol", "seq", "ts", side_sign(F.col("side")).alias("_sign"), *([emit] if emit else [])
    )
    sums = {
        "_nth": F.lit(1).cast("bigint"),
        "_net": F.col("_sign"),
        "_known": F.abs(F.col("_sign")),
    }
    counted = ordered.running(slim, ["symbol"], "seq", sums, chunk_bits=chunk_bits)

    # The last `size` rows of a block are also context for the next block.
    block_rows = 1 << max(chunk_bits, size.bit_length() + 1)
    block = F.floor(F.col("_nth") / block_rows).cast("bigint")
    place = F.pmod(F.col("_nth"), F.lit(block_rows))
    blocks = F.when(place >= block_rows - size, F.array(block, block + 1)).otherwise(F.array(block))
    spread = counted.withColumn("_block", F.explode(blocks))
    spec = Window.partitionBy("symbol", "_block").orderBy("_nth")
    return (
        _ratio_of_running(spread, spec, size)
        .where((F.col("_block") == block) & (F.col(emit) if emit else F.lit(True)))
        .select("symbol", "seq", "ts", "ofi")
    )
