"""A store that is rebuilt by changed days equals a full build."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sample_times import BASE
from tapeloom.functions.timebucket import DAY_MS
from tapeloom.operators import bars
from tapeloom.plans import rebuild_features
from tapeloom.sources import history

START = BASE - BASE % DAY_MS
RULE, WINDOWS = "6h", (2, 6)


def _files(store):
    return {str(p): p.stat().st_mtime_ns for p in Path(store).glob("bars/*/*/*.parquet")}


def _rows(df):
    columns = [c for c in df.columns if c not in ("bar_date", "timestamp")]
    doubles = {n for n, t in df.dtypes if t == "double"}
    shown = [F.round(c, 7).alias(c) if c in doubles else F.col(c) for c in columns]
    return sorted(tuple(r) for r in df.select(F.unix_millis("timestamp").alias("at"), *shown).collect())


def _trades(made, rows):
    return made([(START + int(at * DAY_MS), price, qty, "buy", symbol) for at, price, qty, symbol in rows])


def _check(spark, past, store):
    full = bars.compute(history.load_trades(spark, past), RULE, WINDOWS)
    kept = rebuild_features.load_store(spark, store)
    assert _rows(kept.select(*full.columns)) == _rows(full)
    assert kept.where(F.to_date("timestamp") != F.col("bar_date")).isEmpty()


def test_steps(spark, trades_of, folder):
    past, store = folder("past"), folder("store")

    def step(rows):
        if rows:
            history.append(_trades(trades_of, rows), past)
        changed = rebuild_features.rebuild(spark, past, store, RULE, WINDOWS)
        _check(spark, past, store)
        return changed

    begin = [(d + 0.3 * (d % 3), 100.0 + d, 1.0 + d % 4, s) for d in range(0, 30, 2) for s in ("A+B:c", "007")]
    assert step(begin) == 30
    before = _files(store)
    assert step([]) == 0 and _files(store) == before
    # A day in the middle: only it and what depends on it is written.
    assert step([(12.6, 500.0, 3.0, "007")]) == 1
    after = _files(store)
    gone = {p.split("bar_date=")[1][:10] for p in set(before) - set(after)}
    assert 0 < len(gone) <= 5 and all("symbol=007" in p for p in set(before) - set(after))
    assert {p for p in set(before) & set(after) if before[p] != after[p]} == set()
    # A day after a gap fills the gap; an earlier first day; a symbol that is new.
    assert step([(60.5, 7.0, 1.0, "A+B:c")]) == 1
    assert step([(-20.2, 9.0, 0.0, "A+B:c"), (3.0, 5.0, 2.0, "new")]) == 2
    # Days without a price, or without a volume, change what later days repeat.
    assert step([(62.5, None, 4.0, "A+B:c"), (40.5, 8.0, 0.0, "007"), (14.0, None, None, "007")]) == 3


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_days(spark, trades_of, folder, seed):
    draw = random.Random(seed)
    past, store = folder("past"), folder("store")
    for _ in range(3):
        rows = [
            (draw.randrange(0, 160) / 4 + 0.1, draw.choice([None, 10.0, 11.0, float("nan")]), draw.choice([None, 0.0, 2.0, 3.0]), draw.choice("XY"))
            for _ in range(9)
        ]
        history.append(_trades(trades_of, rows), past)
        rebuild_features.rebuild(spark, past, store, RULE, WINDOWS)
        _check(spark, past, store)


def test_refusals(spark, trades_of, folder):
    past, store = folder("past"), folder("store")
    with pytest.raises(FileNotFoundError):
        rebuild_features.rebuild(spark, past, store)
    history.append(_trades(trades_of, [(0.5, 1.0, 1.0, "A")]), past)
    for rule in ("7min", "2D", "W"):
        with pytest.raises(ValueError, match="divide a day"):
            rebuild_features.rebuild(spark, past, store, rule)
    assert rebuild_features.main([store, "--db", past], spark) == 1
    with pytest.raises(ValueError, match="built with"):
        rebuild_features.rebuild(spark, past, store, "5min")
