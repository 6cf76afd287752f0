"""Job: keep a store of feature bars in step with a growing history.

    spark-submit job.py rebuild_features STORE --db PATH [options]

A ledger tells which files each day was built from. Days whose files changed are
built again, with the days whose bars depend on them: those that repeat or average
over a changed bar, and a gap that a new day closes. Days that only lend context
(last known values, rolling windows) are read, not written. All other files stay.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import session
from ..functions.numbers import nan_to_null
from ..functions.timebucket import DAY_MS, grid, utc_date
from ..operators import bars
from ..sources import history, ledger, paths
from .build_features import DEFAULT_HISTORY

DEFAULT_STORE = "storage/feature_days"


def load_store(spark: SparkSession, store: str) -> DataFrame:
    """The bars of a store, with the columns of ``bars.compute`` and ``bar_date``."""
    path = paths.join(store, "bars")
    paths.require(spark, path, "feature data")
    found = spark.read.parquet(path).drop("symbol", "bar_date").schema
    return spark.read.schema(found.add("symbol", "string").add("bar_date", "date")).parquet(path)


def _told(trades: DataFrame, rule: str) -> DataFrame:
    """(symbol, trade_date, priced, flowing): whether a bar of the day sets prices, and a VWAP."""
    vwap = nan_to_null(F.col("notional") / F.nullif(F.col("volume"), F.lit(0.0)))
    return (
        bars.sparse_bars(trades, rule)
        .groupBy("symbol", utc_date(F.col("bucket")).alias("trade_date"))
        .agg(F.max(F.col("trade_count") > 0).alias("priced"), F.max(vwap.isNotNull()).alias("flowing"))
    )


def dependent_ranges(days: DataFrame, reach: int) -> DataFrame:
    """(symbol, span, out_from, out_to, in_from, in_to) of the changed days, as day numbers.

    ``days`` has (symbol, trade_date, changed, fresh, priced, flowing) for every day with
    trades; ``reach`` is how many days a rolling window may look back. Bars of out_from to
    out_to depend on a changed day and are right if trades of in_from to in_to are read.
    Ranges whose reading overlaps share a span. One row per day meets in a window per symbol.
    """
    own = Window.partitionBy("symbol")
    order = own.orderBy("day")
    earlier = order.rangeBetween(Window.unboundedPreceding, -(reach + 1))
    later = order.rangeBetween(reach + 1, Window.unboundedFollowing)
    following = order.rowsBetween(1, Window.unboundedFollowing)

    first = F.min("day").over(own)

    def known(kind: str):
        return F.coalesce(F.max(F.when(F.col(kind), F.col("day"))).over(earlier), first)

    numbered = days.withColumn("day", F.unix_date("trade_date")).withColumns(
        {
            "context": F.least(known("priced"), known("flowing"), F.col("day") - reach),
            "last": F.max("day").over(own),
            "built": F.max(F.when(~F.col("fresh"), F.col("day"))).over(own),
            # A grid point after the reach makes the bars up to there dense.
            "stop": F.struct("day", F.coalesce(F.min("day").over(later), F.max("day").over(own)).alias("until")),
        }
    )

    def ends(kind: str):
        return F.min(F.when(F.col(kind), F.col("stop"))).over(following)

    # A day after the end of what was built also makes the bars since the day before.
    grown = F.col("day") > F.col("built")
    ranged = numbered.withColumns(
        {
            "before": F.lag("day").over(order),
            "before_context": F.lag("context").over(order),
            "by_price": ends("priced"),
            "by_vwap": ends("flowing"),
        }
    ).where("changed")
    met = F.col("by_price").isNotNull() & F.col("by_vwap").isNotNull()
    stop = F.greatest("by_price", "by_vwap")
    ranges = ranged.select(
        "symbol",
        F.when(grown, F.coalesce("before", "day")).otherwise(F.col("day")).alias("out_from"),
        F.when(met, stop["day"] + reach).otherwise(F.col("last")).alias("out_to"),
        F.when(grown, F.coalesce("before_context", "context")).otherwise(F.col("context")).alias("in_from"),
        F.when(met, stop["until"]).otherwise(F.col("last")).alias("in_to"),
    ).withColumn("in_to", F.greatest("in_to", "out_to"))
    by_start = own.orderBy("in_from", "in_to")
    apart = F.col("in_from") > F.max("in_to").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    parted = ranges.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    return parted.withColumn("span", F.sum("apart").over(by_start.rowsBetween(Window.unboundedPreceding, 0))).drop("apart")


def rebuild(
    spark: SparkSession,
    history_path: str,
    store: str,
    rule: str = bars.DEFAULT_RULE,
    windows: Iterable[int] = bars.DEFAULT_WINDOWS,
) -> int:
    """Bring a store up to date and return how many days of the history had changed.

    Afterwards it holds what ``bars.compute`` gives for the whole history. The rule must
    divide a day: other grids hang on the first day of a symbol, or have bars of many days.
    A build that fails is done again by the next one; builds of one store must not overlap.
    An empty history, or one without changes, leaves the store as it is.
    """
    windows = tuple(dict.fromkeys(int(w) for w in windows))
    buckets = grid(rule)
    if buckets.of_cell_from or buckets.step < 2 or DAY_MS % buckets.step:
        raise ValueError(f"days can only be rebuilt for rules that divide a day, not {rule!r}")
    reach = -(-(max(windows, default=1) + 1) * buckets.step // DAY_MS)
    lines = paths.join(store, "ledger")
    settings = json.dumps({"rule_ms": buckets.step, "windows": windows})
    build = ledger.next_build(spark, lines, settings)
    day = ["symbol", "trade_date"]

    with session.scope(spark):
        known = ledger.known_days(spark, lines).withColumnRenamed("files", "_files")
        listed = ledger.listed_days(spark, history_path).join(known, day, "left").withColumns(
            {"changed": ~F.col("files").eqNullSafe(F.col("_files")), "fresh": F.col("_files").isNull()}
        )
        listed = session.materialize(listed.drop("_files"), "listed")
        count = listed.where("changed").count()
        if not count:
            return 0
        ticks = history.open_history(spark, history_path)
        told = _told(ticks.join(listed.where("changed").select(*day), day), rule)
        told = told.select(*day, F.col("priced").alias("_priced"), F.col("flowing").alias("_flowing"))
        now = {k: F.coalesce(F.when(F.col("changed"), F.col(f"_{k}")).otherwise(F.col(k)), F.lit(False)) for k in ("priced", "flowing")}
        days = session.materialize(listed.join(told, day, "left").withColumns(now).drop("_priced", "_flowing"), "days")

        ranges = session.materialize(dependent_ranges(days, reach), "ranges")
        spans = ranges.groupBy("symbol", "span").agg(F.min("in_from").alias("in_from"), F.max("in_to").alias("in_to"))
        number = F.unix_date("trade_date")
        read = days.select(*day).join(spans, "symbol").where(number.between(F.col("in_from"), F.col("in_to")))
        # Each span is a symbol of its own to the bars, so that their grids stay apart.
        own = F.concat_ws(":", F.col("span"), F.col("symbol"))
        spanned = ticks.join(read.select(*day, "span"), day).withColumn("symbol", own)
        built = bars.compute(spanned, rule, windows).withColumn("bar_date", utc_date(F.unix_millis("timestamp")))
        wanted = ranges.select(
            own.alias("symbol"), F.explode(F.sequence("out_from", "out_to")).alias("_day")
        ).select("symbol", F.date_from_unix_date("_day").alias("bar_date"))
        kept = built.join(wanted, ["symbol", "bar_date"], "left_semi")
        (
            kept.withColumn("symbol", F.regexp_replace("symbol", "^[0-9]+:", ""))
            .repartition("symbol", "bar_date")
            .sortWithinPartitions("symbol", "bar_date", "timestamp")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("symbol", "bar_date")
            .parquet(paths.join(store, "bars"))
        )
        ledger.record(days.where("changed"), lines, build, settings)
    return count


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("store", nargs="?", default=DEFAULT_STORE)
    parser.add_argument("--resample", default=bars.DEFAULT_RULE)
    parser.add_argument("--rolling", nargs="*", type=int, default=list(bars.DEFAULT_WINDOWS))
    parser.add_argument("--db", default=DEFAULT_HISTORY, help="folder of the trade history")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    spark = spark or session.create("rebuild_features")
    return rebuild(spark, args.db, args.store, args.resample, args.rolling)


if __name__ == "__main__":
    print(main())
