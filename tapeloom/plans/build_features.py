"""Job: history to feature bars.

    spark-submit job.py build_features SYMBOL --db PATH [options]
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import SparkSession, functions as F

from .. import session
from ..operators import bars
from ..schema import stamp_symbol
from ..sources import features, history, paths

DEFAULT_HISTORY = "storage/trades"
DEFAULT_OUTDIR = "storage/features"


def build_and_save(
    spark: SparkSession,
    symbol: str,
    output_path: str,
    start_ts: int | None = None,
    end_ts: int | None = None,
    resample: str = bars.DEFAULT_RULE,
    rolling_windows: Iterable[int] = bars.DEFAULT_WINDOWS,
    history_path: str = DEFAULT_HISTORY,
) -> str:
    trades = history.load_trades(spark, history_path, symbol, start_ts, end_ts)
    # Any priced trade yields a bar, so one row answers whether there are bars.
    if trades.where(F.col("ts").isNotNull() & F.col("price").isNotNull() & ~F.isnan("price")).isEmpty():
        raise ValueError("no features to write: no priced trade in the chosen range")
    result = bars.compute(stamp_symbol(trades, symbol), resample, rolling_windows)
    return features.save_features(result, output_path)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("symbol")
    parser.add_argument("--output")
    parser.add_argument("--start-ts", type=int)
    parser.add_argument("--end-ts", type=int)
    parser.add_argument("--resample", default=bars.DEFAULT_RULE)
    parser.add_argument("--rolling", nargs="*", type=int, default=list(bars.DEFAULT_WINDOWS))
    parser.add_argument("--db", default=DEFAULT_HISTORY, help="folder of the trade history")
    parser.add_argument("--outdir", default=DEFAULT_OUTDIR)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = arguments(argv)
    spark = spark or session.create("build_features")
    output = args.output or paths.features_path(args.outdir, args.symbol, args.resample)
    return build_and_save(
        spark, args.symbol, output, args.start_ts, args.end_ts, args.resample, args.rolling, args.db
    )


if __name__ == "__main__":
    print(main())
