"""OHLCV bars on a dense midnight-anchored grid, with fills and rolling columns.

Ticks move once, after map-side aggregation, to their chunk: a symbol's stretch of
time. Everything later works on chunks, so a single symbol spreads over the cluster
however long or busy it is, and of all else only few rows per chunk move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.numbers import nan_to_null
from ..functions.timebucket import DAY_MS, Grid, floor_to, grid, slot_of
from ..schema import with_position, with_symbol

DEFAULT_RULE = "1min"
DEFAULT_WINDOWS = (3, 5, 15)

# Grid points per chunk of the dense stage.
CHUNK_BARS = 4096

# Chunks of a gap that are told together (2**10).
GAP_BITS = 10

# Kinds of rows in a chunk, in order at equal times: what was known before the
# chunk, a bar, and the first grid point after the chunk.
OPENING, BAR, CLOSING = 0, 1, 2

PRICES = ("price_open", "price_high", "price_low", "price_close")
# Columns whose last known value an empty bar repeats.
FILLS = (*PRICES, "vwap")

# A partial bar: some trades of a bucket, with (ts, seq) of the first and the last priced one.
PARTIAL = (
    "first_ts", "first_seq", "price_open", "volume", "trade_count",
    "last_ts", "last_seq", "price_high", "price_low", "price_close", "notional",
)
COUNTS = ("first_ts", "first_seq", "trade_count", "last_ts", "last_seq")
# A column that is NULL equals this one, a NULL notional price_open * volume. So the
# partial bar of a single trade, as most are in thin markets, is small on the way.
SAME = {"last_ts": "first_ts", "last_seq": "first_seq", **dict.fromkeys(("price_high", "price_low", "price_close"), "price_open")}

# Partial bars that a task puts together at once.
MOST_PARTIAL = 1 << 18

# Grid points that a task makes dense at once.
MOST_POINTS = 1 << 16


def sparse_bars(trades: DataFrame, rule: str = DEFAULT_RULE) -> DataFrame:
    """One row per symbol and bucket that has a trade.

    ``bucket`` is the name of the bucket in epoch ms. Open and close follow the
    order ``(ts, seq)`` among trades with a price. The grid starts at midnight
    UTC of the symbol's first day.
    """
    buckets = grid(rule)
    return _numbered_bars(trades, buckets).withColumn("bucket", buckets.label(F.col("bucket")))


def _ticks(trades: DataFrame) -> DataFrame:
    return with_position(with_symbol(trades)).where(F.col("ts").isNotNull()).select(
        "symbol",
        "seq",
        "ts",
        nan_to_null(F.col("price").cast("double")).alias("price"),
        nan_to_null(F.col("qty").cast("double")).alias("qty"),
    )


def _first_days(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(floor_to(F.min("ts"), DAY_MS).alias("origin"))


def _numbered_bars(trades: DataFrame, buckets: Grid) -> DataFrame:
    """Sparse bars by bucket number."""
    grain = buckets.grain
    ticks = _ticks(trades)

    # (ts, seq) as one BIGINT keeps min_by/max_by in the codegen'd hash
    # aggregate; a struct key would sort every tick. The low bits hold seq, its
    # high bits (the era) are a grouping key, so no value range is assumed.
    low_bits = 62 - grain.bit_length()
    era_bits = 63 - low_bits
    if buckets.span.bit_length() + era_bits > 63:
        raise ValueError("resample rule too long")
    order = F.shiftleft(F.pmod(F.col("ts"), F.lit(grain)).cast("bigint"), low_bits).bitwiseOR(
        F.col("seq").bitwiseAND(F.lit((1 << low_bits) - 1))
    )
    cells = (
        ticks.withColumns(
            {
                "cell": floor_to(F.col("ts"), grain),
                "era": F.shiftright(F.col("seq"), low_bits),
                "_at": F.when(F.col("price").isNotNull(), order),
            }
        )
        .groupBy("symbol", "cell", "era")
        .agg(
            F.min("_at").alias("first_at"),
            F.max("_at").alias("last_at"),
            F.min_by("price", "_at").alias("price_open"),
            F.max("price").alias("price_high"),
            F.min("price").alias("price_low"),
            F.max_by("price", "_at").alias("price_close"),
            F.sum("qty").alias("volume"),
            F.count("price").alias("trade_count"),
            F.sum(F.col("price") * F.col("qty")).alias("notional"),
        )
    )

    if buckets.of_cell_from:
        cells = cells.join(_first_days(ticks), "symbol")
        bucket = buckets.of_cell_from(F.col("cell"), F.col("origin"))
    else:
        bucket = buckets.of_cell(F.col("cell"))

    def at(packed: str) -> Column:
        since = F.col("cell") - buckets.start(F.col("bucket")) + F.shiftright(F.col(packed), low_bits)
        return F.shiftleft(since, era_bits).bitwiseOR(F.col("era"))

    return (
        cells.withColumn("bucket", bucket)
        .groupBy("symbol", "bucket")
        .agg(
            F.min_by("price_open", at("first_at")).alias("price_open"),
            F.max("price_high").alias("price_high"),
            F.min("price_low").alias("price_low"),
            F.max_by("price_close", at("last_at")).alias("price_close"),
            F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
            F.sum("trade_count").alias("trade_count"),
            F.coalesce(F.sum("notional"), F.lit(0.0)).alias("notional"),
        )
    )


def _combined(rows: dict[str, np.ndarray], begin: np.ndarray) -> dict[str, np.ndarray]:
    """One partial bar for each run of rows; ``begin`` holds each run's first row."""
    size = np.diff(np.append(begin, len(rows["volume"])))
    out = {c: rows[c][begin] for c in PARTIAL}
    several = np.flatnonzero(size > 1)
    if not len(several):
        return out
    inside = np.repeat(size > 1, size)
    part, length = {c: rows[c][inside] for c in PARTIAL}, size[several]
    low = np.cumsum(length) - length
    for c, together in {"price_high": np.fmax, "price_low": np.fmin, "volume": np.add, "trade_count": np.add, "notional": np.add}.items():
        out[c][several] = together.reduceat(part[c], low)
    # The first and the last row with a price; of several at one (ts, seq) the one that came last.
    run, priced, came = np.repeat(np.arange(len(several)), length), part["trade_count"] > 0, np.arange(np.sum(length))
    first = np.lexsort((-came, part["first_seq"], part["first_ts"], ~priced, run))[low]
    last = np.lexsort((came, part["last_seq"], part["last_ts"], priced, run))[low + length - 1]
    for row, columns in ((first, ("first_ts", "first_seq", "price_open")), (last, ("last_ts", "last_seq", "price_close"))):
        for c in columns:
            out[c][several] = part[c][row]
    return out


def _unpacked(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The columns of partial bars without what ``SAME`` leaves out; a missing price is NaN."""
    found = {c: rows.column(c) for c in PARTIAL}
    found["notional"] = pc.coalesce(found["notional"], pc.multiply(found["price_open"], found["volume"]))
    found |= {c: pc.coalesce(found[c], found[of]) for c, of in SAME.items()}
    return {c: v.to_numpy(zero_copy_only=False) for c, v in found.items()}


def _packed(found: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    same = {c: found[c].view(np.int64) == found[of].view(np.int64) for c, of in SAME.items()}
    same["notional"] = found["notional"].view(np.int64) == (found["price_open"] * found["volume"]).view(np.int64)
    return {c: pa.array(v, mask=same.get(c)) for c, v in found.items()}


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode("encode").indices.to_numpy()


def _one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial bars of as many trades of a task as fit, by symbol and bucket."""
    held: list[pa.RecordBatch] = []

    def put() -> pa.RecordBatch:
        rows = _one_batch(held)
        symbol, bucket = _codes(rows.column("symbol")), rows.column("bucket").to_numpy()
        order = np.lexsort((bucket, symbol))
        symbol, bucket = symbol[order], bucket[order]
        begin = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (bucket[1:] != bucket[:-1])]))
        with np.errstate(all="ignore"):
            found = _packed(_combined({c: v[order] for c, v in _unpacked(rows).items()}, begin))
        columns = {"symbol": rows.column("symbol").take(pa.array(order[begin])), "bucket": pa.array(bucket[begin]), **found}
        return pa.RecordBatch.from_arrays([columns[c] for c in rows.schema.names], schema=rows.schema)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) >= MOST_PARTIAL:
            held[:] = [put()]
            if held[0].num_rows > MOST_PARTIAL // 2:
                yield held.pop()
    if held:
        yield put()


def _partial_bars(trades: DataFrame, buckets: Grid) -> DataFrame:
    """(symbol, bucket, partial bar): the trades put together within each task that reads them."""
    ticks = _ticks(trades)
    cell = floor_to(F.col("ts"), buckets.grain)
    schema = T.StructType([
        ticks.schema["symbol"],
        *(T.StructField(c, T.LongType() if c in ("bucket", *COUNTS) else T.DoubleType()) for c in ("bucket", *PARTIAL)),
    ])
    priced = F.col("price").isNotNull()
    # A trade is a partial bar, too.
    told = {
        "first_ts": F.col("ts"),
        "first_seq": F.col("seq"),
        "price_open": F.col("price"),
        "volume": F.coalesce("qty", F.lit(0.0)),
        "trade_count": F.when(priced, 1).otherwise(0),
        "notional": F.when(~priced | F.col("qty").isNull(), 0.0),
    }
    single = ticks.select(
        "symbol",
        (cell if buckets.of_cell_from else buckets.of_cell(cell)).cast("bigint").alias("bucket"),
        *[told.get(c, F.lit(None)).cast(schema[c].dataType).alias(c) for c in PARTIAL],
    )
    partial = single.mapInArrow(_put_together, schema)
    if buckets.of_cell_from is None:
        return partial
    bucket = buckets.of_cell_from(F.col("bucket"), F.col("origin"))
    return partial.join(_first_days(ticks), "symbol").select("symbol", bucket.alias("bucket"), *PARTIAL).mapInArrow(_put_together, schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks in order, with one row for the partial bars of a bucket."""
    keys = ("symbol", "chunk", "bucket", "kind")
    held: list[pa.RecordBatch] = []

    def bars(rows: pa.RecordBatch) -> pa.RecordBatch:
        volume, notional = rows.column("volume").to_numpy(), rows.column("notional").to_numpy()
        with np.errstate(all="ignore"):
            vwap = np.where(volume != 0, notional / volume, np.nan)
        # An opening row has no trades; what it tells of the VWAP stands in place of the notional.
        vwap = np.where(rows.column("kind").to_numpy() == OPENING, notional, vwap)
        columns = {c: rows.column(c) for c in (*keys, *PRICES, "volume", "trade_count")} | {"vwap": pa.array(vwap)}
        names = [*keys, *FILLS, "volume", "trade_count"]
        return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _one_batch([*held, batch.select([*keys, *PARTIAL])])
        told = [_codes(rows.column("symbol")), *(rows.column(c).to_numpy() for c in keys[1:])]
        begin = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in told], axis=0)))
        with np.errstate(all="ignore"):
            found = _combined(_unpacked(rows), begin)
        columns = {c: rows.column(c).take(pa.array(begin)) for c in keys} | {c: pa.array(v) for c, v in found.items()}
        rows = pa.RecordBatch.from_arrays([columns[c] for c in rows.schema.names], schema=rows.schema)
        held[:] = [rows.slice(len(begin) - 1)]  # the last bucket may go on
        if len(begin) > 1:
            yield bars(rows.slice(0, len(begin) - 1))
    for rows in held:
        yield bars(rows)


def _border_bars(batches: Iterator[pa.RecordBatch], step: int, width: int, tail: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Of the bars of chunks in order, those that ``_carries`` can need: the last ones of each zone."""
    for rows in _merged(batches):
        bucket, chunk = rows.column("bucket").to_numpy(), rows.column("chunk").to_numpy()
        rows = rows.filter(pa.array(bucket // width == chunk))  # without those lent by the chunk before
        if not rows.num_rows:
            continue
        bucket, symbol = rows.column("bucket").to_numpy(), _codes(rows.column("symbol"))
        zone = bucket // width * 2 + (bucket % width >= width - tail * step)
        begin = np.flatnonzero(np.append(True, (symbol[1:] != symbol[:-1]) | (zone[1:] != zone[:-1])))
        at = np.arange(len(zone))
        known = (rows.column("trade_count").to_numpy() > 0, ~np.isnan(rows.column("vwap").to_numpy()), at >= 0)
        last = np.unique([np.maximum.reduceat(np.where(x, at, -1), begin) for x in known])
        last = pa.array(last[last >= 0])
        found = {c: rows.column(c).take(last) for c in rows.schema.names if c in names} | {"zone": pa.array(zone).take(last)}
        found |= {c: pa.array(found[c].to_numpy(), from_pandas=True) for c in FILLS}
        yield pa.RecordBatch.from_arrays([found[c] for c in names], names=names)


def _carries(sparse: DataFrame, step: int, chunk_bars: int, halo: int) -> DataFrame:
    """Rows that tell a chunk what was known before it and where it ends.

    Bars are summed up per zone; a chunk has two zones, the second being the
    stretch that its successor needs as context. Only zone summaries, one or
    two rows per chunk, go through a window over the whole symbol.
    """
    width = step * chunk_bars
    spec = Window.partitionBy("symbol").orderBy("zone")
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    fills = (*PRICES, "vwap")
    known = {c: F.when(F.col("trade_count") > 0, F.col("bucket")) for c in PRICES}
    known["vwap"] = F.when(F.col("vwap").isNotNull(), F.col("bucket"))
    pairs = (
        sparse.groupBy("symbol", "zone")
        .agg(
            *[F.max_by(c, known[c]).alias(c) for c in fills],
            F.min(F.pmod(F.col("bucket"), F.lit(step))).alias("phase"),
        )
        .select(
            "symbol",
            "zone",
            "phase",
            *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in fills],
            F.lead("zone").over(spec).alias("next_zone"),
        )
    )

    zone, following = F.col("zone"), F.col("next_zone")
    phase = F.col("phase")

    def marks(first: Column, last: Column, kind: int, offset: int) -> Column:
        at = F.lit(offset).cast("bigint") + phase
        return F.struct(first.alias("first"), last.alias("last"), F.lit(kind).alias("kind"), at.alias("at"))

    half = F.shiftright
    openings = marks(half(zone + 1, 1) + 1, half(following + 1, 1), OPENING, -halo * step)
    closings = marks(half(zone, 1), half(following, 1) - 1, CLOSING, width)
    # A gap may span millions of chunks, so they are told in two steps.
    low, block = F.shiftleft(F.col("block"), GAP_BITS), F.sequence(half("first", GAP_BITS), half("last", GAP_BITS))
    return (
        pairs.where("next_zone IS NOT NULL")
        .select("symbol", F.inline(F.array(openings, closings)), *fills)
        .where("first <= last")
        .withColumn("block", F.explode(block))
        .withColumn("chunk", F.explode(F.sequence(F.greatest("first", low), F.least("last", low + ((1 << GAP_BITS) - 1)))))
        .select("symbol", "chunk", (F.col("chunk") * width + F.col("at")).alias("bucket"), "kind", *fills)
    )


def _chunk_rows(trades: DataFrame, buckets: Grid, halo: int, chunk_bars: int) -> DataFrame:
    """(symbol, chunk, bucket, kind, partial bar): the rows that tell each chunk, in its order.

    A chunk gets its bars, those of the ``halo`` points before it, and rows that tell
    what was known before and where it ends.
    """
    step = buckets.step
    width = step * chunk_bars
    bucket = F.col("bucket")
    own_chunk = slot_of(bucket, width)
    in_tail = F.pmod(bucket, F.lit(width)) >= (chunk_bars - halo) * step
    # The only exchange of all bars; both uses below read all of its columns, so that it is made once.
    partial = (
        _partial_bars(trades, buckets)
        .withColumn("chunk", F.explode(F.when(in_tail, F.array(own_chunk, own_chunk + 1)).otherwise(F.array(own_chunk))))
        .repartition("symbol", "chunk")
        .withColumn("kind", F.lit(BAR))
    )
    names = ["symbol", "bucket", "zone", *FILLS, "trade_count"]
    schema = T.StructType([
        partial.schema["symbol"],
        *(T.StructField(c, T.DoubleType() if c in FILLS else T.LongType()) for c in names[1:]),
    ])
    border = partial.sortWithinPartitions("symbol", "chunk", "bucket").mapInArrow(
        lambda batches: _border_bars(batches, step, width, halo, names), schema
    )
    empty = {c: F.lit(0 if c in COUNTS else 0.0 if c == "volume" else None) for c in PARTIAL}
    # NaN and not NULL, which would stand for open * volume.
    told = {c: F.col(c) for c in PRICES} | {"notional": F.coalesce("vwap", F.lit(float("nan")))}
    carries = _carries(border, step, chunk_bars, halo)
    # A row that shows nothing. Adaptive execution drops a side without rows, and would then
    # merge partitions of the other. Gaps make the rows grow up to a thousand times below, so
    # their size here must not decide how many tasks share them.
    blank = trades.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(None).alias(c) for c in ("symbol", *FILLS)], *[F.lit(0).alias(c) for c in ("chunk", "bucket")], F.lit(CLOSING).alias("kind")
    )
    tasks = int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = carries.unionByName(blank).select(
        "symbol", "chunk", "bucket", "kind", *[told.get(c, empty[c]).cast(partial.schema[c].dataType).alias(c) for c in PARTIAL]
    )
    rows = partial.unionByName(extra.repartition(tasks, "symbol", "chunk"))
    # Both sides are dealt as the window needs them, so it moves nothing; it makes sure of that, and sorts.
    order = Window.partitionBy("symbol", "chunk").orderBy("bucket", "kind")
    return rows.withColumn("place", F.row_number().over(order))


def _last_known(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Each value or, where it is NaN, the last one known since ``start``, the first row of its chunk."""
    at = np.maximum.accumulate(np.where(np.isnan(values), -1, np.arange(len(values))))
    return np.where(at >= start, values[at], np.nan)


def _earlier(values: np.ndarray, k: int) -> np.ndarray:
    """Every row's value ``k`` rows before; rows without one get what stands for nothing."""
    out = np.full(len(values), np.nan)
    out[k:] = values[: len(values) - k]
    return out


def _rolled(values: np.ndarray, place: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(value, is it there and finite) of the rows of each row's window, the oldest first."""
    for k in range(window - 1, -1, -1):
        value = _earlier(values, k) if k < len(values) else np.full(len(values), np.nan)
        yield value, np.isfinite(value) & (place >= k)


def rolling_mean(values: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """Mean of the finite values of the window, NaN without any; ``place`` counts rows within their chunk."""
    total, n = np.zeros(len(values)), np.zeros(len(values))
    for value, good in _rolled(values, place, window):
        total += np.where(good, value, 0.0)
        n += good
    return total / n


def rolling_deviation(values: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """Sample deviation of the finite values of the window by updates of mean and moment; 0 for fewer than two."""
    n, mean, moment = np.zeros(len(values)), np.zeros(len(values)), np.zeros(len(values))
    for value, good in _rolled(values, place, window):
        n += good
        delta = np.where(good, value - mean, 0.0)
        part = delta / np.maximum(n, 1.0)
        mean += part
        moment += delta * (delta - part)
    return np.where(n > 1, np.sqrt(moment / np.maximum(n - 1, 1.0)), 0.0)


def step_returns(value: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Relative change to the previous value; 0 at the start and for 0/0."""
    grown = np.where(value > 0, np.inf, np.where(value < 0, -np.inf, 0.0))
    return np.where(np.isnan(value) | np.isnan(before), 0.0, np.where(before == 0, grown, value / before - 1))


def _dense(told: dict[str, np.ndarray], begin: np.ndarray, step: int, width: int, windows: tuple[int, ...], ahead: int) -> dict[str, np.ndarray]:
    """The feature bars of whole chunks from their rows; ``begin`` holds each chunk's first row, ``row`` of the result the row of a bar."""
    n = len(told["bucket"])
    length = np.diff(np.append(begin, n))
    start = np.repeat(begin, length)
    bucket, last = told["bucket"], np.append(begin[1:], n) - 1
    until = np.append(bucket[1:], 0)
    until[last] = bucket[last] + step
    shown = (told["kind"] != CLOSING) & (until > bucket)
    points = np.where(shown, np.maximum((until - bucket) // step, 1), 0)
    row = np.repeat(np.arange(n), points)
    into = np.arange(len(row)) - np.repeat(np.cumsum(points) - points, points)
    has_trade = into == 0
    slot = bucket[row] + into * step
    # Rows of a chunk are next to each other, in the dense table too.
    at = start[row]
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    place = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))

    out = {c: _last_known(told[c], start)[row] for c in FILLS}
    close = out["price_close"]
    out["vwap"] = np.where(np.isnan(out["vwap"]), close, out["vwap"])
    out["volume"] = np.where(has_trade, told["volume"][row], 0.0)
    out["trade_count"] = np.where(has_trade, told["trade_count"][row], 0)
    out["return_1"] = step_returns(close, np.where(place > 0, _earlier(close, 1), np.nan))
    for w in windows:
        out[f"ma_{w}"] = rolling_mean(close, place, w)
        out[f"vol_{w}"] = rolling_deviation(out["return_1"], place, w)
        out[f"volumema_{w}"] = rolling_mean(out["volume"], place, w)
    if ahead:
        later = np.full(len(row), np.nan)
        later[: max(0, len(row) - ahead)] = np.where(at[ahead:] == at[: max(0, len(row) - ahead)], close[ahead:], np.nan)
        out["price_ahead"] = later
    # Points that belong to the chunk: with ``ahead``, those whose ``ahead``-th successor lies in its stretch of time.
    keep = (slot + ahead * step) // width == told["chunk"][row]
    for column in out.values():
        keep &= ~np.isnan(column)
    return {c: v[keep] for c, v in {"bucket": slot, "row": row, **out}.items()}


def _bars_of_chunks(batches: Iterator[pa.RecordBatch], step: int, width: int, windows: tuple[int, ...], ahead: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks in order, made dense some whole chunks at a time."""
    held: list[pa.RecordBatch] = []

    def cut(rows: pa.RecordBatch, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        # Parts of at most about MOST_POINTS grid points, or one chunk.
        bucket = rows.column("bucket").to_numpy()
        most = (bucket[np.append(begin[1:], rows.num_rows) - 1] - bucket[begin]) // step + 1
        part = np.cumsum(most) // MOST_POINTS
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        for a, b in zip(first, np.append(first[1:], len(begin)), strict=True):
            low, high = begin[a], begin[b] if b < len(begin) else rows.num_rows
            here = rows.slice(low, high - low)
            told = {c: here.column(c).to_numpy(zero_copy_only=False) for c in here.schema.names if c != "symbol"}
            with np.errstate(all="ignore"):
                made = _dense(told, begin[a:b] - low, step, width, windows, ahead)
            columns = [here.column("symbol").take(pa.array(made["row"])) if c == "symbol" else pa.array(made[c]) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def whole(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        held.clear()
        for rows in rows[:1]:
            symbol = _codes(rows.column("symbol"))
            chunk = rows.column("chunk").to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (chunk[1:] != chunk[:-1])]))
            if not last:  # the last chunk may go on
                held.append(rows.slice(begin[-1]))
                rows, begin = rows.slice(0, begin[-1]), begin[:-1]
            if len(begin):
                yield from cut(rows, begin)

    for batch in batches:
        held.append(batch)
        yield from whole(False)
    if held:
        yield from whole(True)


def feature_columns(windows: Iterable[int]) -> list[str]:
    return [f"{name}_{w}" for w in windows for name in ("ma", "vol", "volumema")]


def compute(
    trades: DataFrame,
    rule: str = DEFAULT_RULE,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """Feature bars: dense OHLCV, VWAP, one-step return and rolling columns.

    Rows still missing a value (before the first price) are dropped last, so
    they count in the rolling windows. Empty trades give empty bars.
    """
    return features(trades, rule, windows, chunk_bars)


def features(
    trades: DataFrame,
    rule: str = DEFAULT_RULE,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    chunk_bars: int = CHUNK_BARS,
    ahead: int = 0,
) -> DataFrame:
    """The bars of ``compute``; with ``ahead`` also ``price_ahead``, the close that
    many bars later, for all bars that have one."""
    windows = tuple(dict.fromkeys(int(w) for w in windows))
    if any(w < 1 for w in windows):
        raise ValueError("rolling windows must be at least 1")
    halo = max(windows, default=1) + ahead
    buckets = grid(rule)
    chunk_bars = max(chunk_bars, 4 * halo)
    step, width = buckets.step, buckets.step * chunk_bars
    values = [
        "price_close", "price_open", "price_high", "price_low", "volume", "trade_count", "vwap", "return_1",
        *feature_columns(windows), *["price_ahead"] * (ahead > 0),
    ]
    names = ["symbol", "bucket", *values]
    rows = _chunk_rows(trades, buckets, halo, chunk_bars)
    whole = ("bucket", "trade_count")
    schema = T.StructType([rows.schema["symbol"], *(T.StructField(c, T.LongType() if c in whole else T.DoubleType()) for c in names[1:])])
    dense = rows.mapInArrow(lambda batches: _bars_of_chunks(_merged(batches), step, width, windows, ahead, names), schema)
    return dense.select(F.timestamp_millis(buckets.label(F.col("bucket"))).alias("timestamp"), *values, "symbol")
