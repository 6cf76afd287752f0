from __future__ import annotations

import sys
from pathlib import Path

import pytest

# The package, and helpers that only tests share; no test module imports `conftest`.
sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from sample_times import BASE  # noqa: E402
from tapeloom import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session.create(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture()
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


TRADE_SCHEMA = "symbol string, seq bigint, ts bigint, price double, qty double, side string"


@pytest.fixture(scope="session")
def trades_of(spark):
    """Trades from ``(ts, price, qty[, side[, symbol]])`` tuples; seq is the list index."""

    def make(rows, schema=TRADE_SCHEMA):
        full = []
        for seq, row in enumerate(rows):
            ts, price, qty, side, symbol = (*row, *("buy", "BTCUSDT")[len(row) - 3 :])
            full.append((symbol, seq, ts, price, qty, side))
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def ten_trades(trades_of):
    prices = [100.0, 101.0, 102.0, 101.5, 100.5, 99.5, 100.2, 99.8, 100.4, 99.9]
    return trades_of(
        [
            (BASE + 60_000 * i, p, 1.0 + 0.1 * (i % 3), "buy" if i % 2 == 0 else "sell")
            for i, p in enumerate(prices)
        ]
    )
