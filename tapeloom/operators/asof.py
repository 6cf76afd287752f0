"""As-of joins: to each row the newest row of another frame that is not later.

No key is one task's: time is cut into chunks, a chunk of a key gets one row that
tells what was newest before it, and a chunk with very many rows on the left is split
further, each part with the few rows of the right side that it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timebucket import DAY_MS, rule_ms
from ..schema import with_symbol
from ..session import materialize

# 2**22 ms, about 70 minutes.
CHUNK_BITS = 22
# Left rows that one task orders; chunks with more are split.
MOST_ROWS = 1 << 20

_OPENING, _RIGHT, _LEFT = 0, 1, 2


def join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    chunk_bits: int = CHUNK_BITS,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """All rows of `left` with the columns of the newest `right` row of the same keys
    whose `right_time` is not after `left_time`; NULL where there is none.

    Times are BIGINT. NULL keys or times match nothing. Of several right rows at one
    time the greatest by its columns counts. The right side's other columns must have
    names that the left side lacks, and types that can be ordered. Both sides are read
    twice, once for keys and times only.
    """
    clash = (set(right.columns) - set(keys)) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
    own = [f"_key{i}" for i in range(len(keys))]
    parts = [*own, "_chunk"]

    def keyed(df: DataFrame, time: str, names: Sequence[str]) -> list:
        chunk = F.shiftright(F.col(f"`{time}`"), chunk_bits).alias("_chunk")
        at = F.col(f"`{time}`").alias("_at")
        return [*[F.col(f"`{k}`").alias(o) for k, o in zip(keys, own, strict=True)], at, chunk]

    fields = [c for c in right.columns if c not in keys]
    found = F.struct(*[F.col(f"`{c}`") for c in fields]).alias("_found")
    rows = left.select(*keyed(left, left_time, keys), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    known = right.select(*keyed(right, right_time, keys), found).where(F.col("_at").isNotNull())
    for key in own:
        known = known.where(F.col(key).isNotNull())

    newest = F.max(F.struct("_at", "_found")).alias("_last")
    marks = known.groupBy(*parts).agg(newest, F.lit(0).cast("bigint").alias("_n")).unionByName(
        rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")), allowMissingColumns=True
    )
    # A row per key and chunk.
    marks = materialize(marks.groupBy(*parts).agg(F.max("_last").alias("_last"), F.sum("_n").alias("_n")), "asof-chunks")
    before = Window.partitionBy(*own).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    opening = marks.where(F.col("_chunk").isNotNull()).withColumn("_last", F.last("_last", ignorenulls=True).over(before))
    opening = opening.where(F.col("_last").isNotNull() & (F.col("_n") > 0)).select(
        *parts, F.shiftleft("_chunk", chunk_bits).alias("_at"), F.col("_last._found").alias("_found")
    )
    # Few: at most one for every `most_rows` rows.
    crowded = materialize(
        marks.where(F.col("_n") > most_rows).select(*parts, F.ceil(F.col("_n") / most_rows).cast("int").alias("_parts")), "asof-crowded"
    )
    split = F.coalesce("_parts", F.lit(1))
    mine = rows.join(crowded, parts, "left").withColumn("_part", F.pmod(F.monotonically_increasing_id(), split).cast("int")).drop("_parts")
    told = known.withColumn("_kind", F.lit(_RIGHT)).unionByName(opening.withColumn("_kind", F.lit(_OPENING)))
    told = told.join(crowded, parts, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), split - 1))).drop("_parts")
    both = mine.withColumn("_kind", F.lit(_LEFT)).unionByName(told, allowMissingColumns=True)
    order = Window.partitionBy(*parts, "_part").orderBy("_at", "_kind", "_found").rowsBetween(Window.unboundedPreceding, 0)
    answered = both.withColumn("_found", F.last("_found", ignorenulls=True).over(order)).where(F.col("_kind") == _LEFT)
    return answered.select("_row.*", *[F.col(f"_found.`{c}`").alias(c) for c in fields])


def closed_features(trades: DataFrame, features: DataFrame, rule: str, **options: int) -> DataFrame:
    """Trades with the columns of the newest bar that had ended when they happened.

    `features` are bars of `rule` by `timestamp`, as `bars.compute` makes them; the end
    of the bar found is `closed_at`. A trade at the very end of a bar sees it. Trades
    before the end of the first bar have NULLs, which a model takes for its defaults.
    Without a symbol on either side there is one symbol.
    """
    step = rule_ms(rule)
    if DAY_MS % step:
        raise ValueError(f"bars of {rule} don't end with the day")
    ended = with_symbol(features).withColumn("closed_at", F.unix_millis("timestamp") + step)
    return join(with_symbol(trades), ended.drop("timestamp"), ["symbol"], "ts", "closed_at", **options)
