"""Ordered per-key computations that never put one key into one task.

A plain ``Window.partitionBy(key)`` hands a whole key to one task. Here rows are
cut into chunks by their position, so a task sees at most one chunk of a key,
and only what crosses a chunk border travels a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

# Positions per chunk (2**22, so at most four million rows of a key in a task) and
# how much wider each further level is (2**9).
CHUNK_BITS = 22
LEVEL_BITS = 9
LEVELS = 2

_CHUNK, _RANK, _TAIL, _EMIT = "_chunk", "_rank", "_tail", "_emit"


def framed(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    back: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    descending: bool = False,
    emit: str | None = None,
    chunk_bits: int = CHUNK_BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """Window columns that look at most ``back`` rows back, for any key size.

    ``build`` adds the columns to a frame, given the window spec to use.
    ``position`` is a BIGINT, unique per key. A row with more than ``back`` rows before it in its
    own chunk is final after one shuffle. The others, at most ``back`` per
    chunk, are settled again among chunk heads and tails on chunks 2**9 times
    as wide. Rows whose ``emit`` column is false only serve as context.
    """
    flagged = df.withColumn(_EMIT, F.lit(True) if emit is None else F.col(emit))
    kept = df.columns
    pieces = []
    for level in range(levels + 1):
        part = list(keys)
        if level < levels:
            flagged = flagged.withColumn(_CHUNK, F.shiftright(F.col(position), chunk_bits + level * LEVEL_BITS))
            part.append(_CHUNK)
        order = F.col(position).desc() if descending else F.col(position).asc()
        spec = Window.partitionBy(*part).orderBy(order)
        last = level == levels
        ranked = flagged.withColumn(_RANK, F.row_number().over(spec))
        final = F.col(_EMIT) if last else F.col(_EMIT) & (F.col(_RANK) > back)
        pieces.append(build(ranked, spec).where(final).drop(_CHUNK, _RANK, _EMIT))
        if not last:
            head = F.col(_RANK) <= back
            tail = F.lead(F.lit(1), back).over(spec).isNull()
            flagged = (
                ranked.withColumn(_TAIL, tail)
                .where(head | F.col(_TAIL))
                .withColumn(_EMIT, F.col(_EMIT) & head)
                .select(*kept, _EMIT)
            )
    result = pieces[0]
    for piece in pieces[1:]:
        result = result.unionByName(piece)
    return result


def offsets(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    sums: dict[str, Column],
) -> DataFrame:
    """What each chunk starts from: totals of all earlier chunks of its key.

    One row per chunk; the totals are summed map-side before they move.
    """
    totals = df.groupBy(*keys, chunk).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys, chunk, *[F.coalesce(F.sum(n).over(before), F.lit(0).cast("bigint")).alias(n) for n in sums]
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    sums: dict[str, Column],
    *,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Inclusive running sums per key in position order, by chunk and offset.

    Chunk-local sums and chunk offsets meet in an equi-join on the partitioning
    the rows already have, so the rows are shuffled once.
    """
    chunked = df.withColumn(_CHUNK, F.shiftright(F.col(position), chunk_bits))
    start = offsets(chunked, keys, _CHUNK, sums).withColumnsRenamed({n: f"{n}__before" for n in sums})
    spec = Window.partitionBy(*keys, _CHUNK).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumns({n: F.sum(c).over(spec) for n, c in sums.items()})
    joined = local.join(start, [*keys, _CHUNK])
    return joined.withColumns({n: F.col(n) + F.col(f"{n}__before") for n in sums}).select(*df.columns, *sums)


def latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    count: int,
    *,
    salts: int = 64,
) -> DataFrame:
    """The ``count`` rows of highest position per key.

    Every map task passes on at most ``count`` rows per key, the salts share
    what a hot key's many map tasks pass on, and the last step sees at most
    ``salts * count`` rows per key. The salt is the same for all rows of a map
    task, so it does not weaken the limit there.
    """
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = Window.partitionBy(*keys, "_salt").orderBy(F.col(position).desc())
    second = Window.partitionBy(*keys).orderBy(F.col(position).desc())
    return (
        salted.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= count)
        .withColumn("_n", F.row_number().over(second))
        .where(F.col("_n") <= count)
        .drop("_salt", "_n")
    )
