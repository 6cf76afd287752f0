import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import bars, labels
from tapeloom.sources import history

from sample_times import BASE


def table(df):
    frame = df.withColumn("bucket", F.unix_millis("timestamp")).drop("timestamp").toPandas()
    return frame.sort_values(["symbol", "bucket"]).reset_index(drop=True)


def expected_bars(rows, rule, windows):
    """Brute force with a resampler, one symbol at a time, on a small list."""
    out = []
    for symbol in sorted({r["symbol"] for r in rows}):
        part = sorted((r for r in rows if r["symbol"] == symbol), key=lambda r: (r["ts"], r["seq"]))
        index = pd.to_datetime([r["ts"] for r in part], unit="ms", utc=True)
        price = pd.Series([r["price"] for r in part], index=index, dtype=float)
        qty = pd.Series([r["qty"] for r in part], index=index, dtype=float)
        by = price.resample(rule)
        volume = qty.resample(rule).sum()
        frame = pd.DataFrame(
            {
                "price_close": by.last().ffill(), "price_open": by.first().ffill(),
                "price_high": by.max().ffill(), "price_low": by.min().ffill(),
                "volume": volume, "trade_count": by.count(),
            }
        )
        ratio = (price * qty).resample(rule).sum() / volume.where(volume != 0)
        frame["vwap"] = ratio.ffill().fillna(frame["price_close"])
        frame["return_1"] = frame["price_close"].pct_change(fill_method=None).fillna(0)
        for w in windows:
            finite = frame["return_1"].replace([np.inf, -np.inf], np.nan)
            frame[f"ma_{w}"] = frame["price_close"].rolling(w, min_periods=1).mean()
            frame[f"vol_{w}"] = [finite.iloc[max(0, i - w + 1) : i + 1].std() for i in range(len(finite))]
            frame[f"vol_{w}"] = frame[f"vol_{w}"].fillna(0)
            frame[f"volumema_{w}"] = frame["volume"].rolling(w, min_periods=1).mean()
        frame = frame.dropna()
        frame["symbol"] = symbol
        frame["bucket"] = frame.index.as_unit("ns").asi8 // 1_000_000
        out.append(frame)
    return pd.concat(out).sort_values(["symbol", "bucket"]).reset_index(drop=True)


def assert_same(got, want):
    assert list(got["bucket"]) == list(want["bucket"])
    assert list(got["symbol"]) == list(want["symbol"])
    for c in want.columns:
        if c not in ("symbol", "bucket"):
            np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_ten_trades(ten_trades):
    got = table(bars.compute(ten_trades, "1min", (3,)))
    assert list(got["bucket"]) == [1699999980000 + 60_000 * i for i in range(10)]
    assert list(got["price_close"]) == list(got["price_open"]) == list(got["vwap"].round(9))
    assert list(got["trade_count"]) == [1] * 10
    np.testing.assert_allclose(
        got["vol_3"],
        [0, 0.0070710678, 0.0057451343, 0.0085752123, 0.0102779827, 0.0028867472, 0.0097783629, 0.0086178511, 0.0060927090, 0.0060811653],
        atol=5e-10,
    )
    np.testing.assert_allclose(got["volumema_3"], [1, 1.05] + [1.1] * 8)
    assert bars.compute(ten_trades, "1min", (3,)).columns == [
        "timestamp", "price_close", "price_open", "price_high", "price_low", "volume", "trade_count", "vwap",
        "return_1", "ma_3", "vol_3", "volumema_3", "symbol",
    ]


def test_ties_gaps_and_zero_volume(trades_of):
    day = 1704067200000
    trades = trades_of(
        [
            (day + 10_000, 5.0, 0.0),  # leading bucket without volume: VWAP is the close
            (day + 60_000, 10.0, 2.0),
            (day + 60_000, 11.0, 2.0),  # same time: arrival decides open and close
            (day + 60_000, 9.0, 0.0),
            (day + 300_000, 20.0, 0.0),  # after three empty buckets, no volume: VWAP carries on
            (day + 300_500, None, 4.0),
            (day + 360_000, float("nan"), 3.0),  # no price at all: prices carry on, VWAP is 0/3
        ]
    )
    got = table(bars.compute(trades, "1min", (2,)))
    assert list(got["price_open"]) == [5, 10, 10, 10, 10, 20, 20]
    assert list(got["price_close"]) == [5, 9, 9, 9, 9, 20, 20]
    assert list(got["price_high"]) == [5, 11, 11, 11, 11, 20, 20]
    assert list(got["volume"]) == [0, 4, 0, 0, 0, 4, 3]
    assert list(got["trade_count"]) == [1, 3, 0, 0, 0, 1, 0]
    assert list(got["vwap"]) == [5, 10.5, 10.5, 10.5, 10.5, 0, 0]


def test_leading_rows_without_price_count_in_windows(trades_of):
    day = 1704067200000
    trades = trades_of([(day, None, 6.0), (day + 60_000, 4.0, 2.0), (day + 120_000, 8.0, 1.0)])
    got = table(bars.compute(trades, "1min", (2,)))
    assert list(got["bucket"]) == [day + 60_000, day + 120_000]
    assert list(got["volumema_2"]) == [4.0, 1.5]
    assert list(got["return_1"]) == [0.0, 1.0]
    assert got["vol_2"][0] == 0.0


def test_zero_prices(trades_of):
    day = 1704067200000
    trades = trades_of([(day + 60_000 * i, p, 1.0) for i, p in enumerate([0.0, 0.0, 3.0, 0.0, -2.0])])
    got = table(bars.compute(trades, "1min", (5,)))
    assert list(got["return_1"]) == [0.0, 0.0, math.inf, -1.0, -math.inf]
    # Infinite returns are left out of the deviation.
    np.testing.assert_allclose(got["vol_5"].iloc[-1], np.std([0.0, 0.0, -1.0], ddof=1))


def test_empty_and_one_row(spark, trades_of):
    assert bars.compute(trades_of([])).count() == 0
    got = table(bars.compute(trades_of([(BASE, 7.0, 2.0)])))
    assert len(got) == 1 and got["vol_15"][0] == 0 and got["ma_15"][0] == 7
    bare = spark.createDataFrame([(0, BASE, 1.0, 1.0, "buy")], "seq bigint, ts bigint, price double, qty double, side string")
    assert table(bars.compute(bare))["symbol"].tolist() == ["UNKNOWN"]


@pytest.mark.parametrize("rule", ["1min", "7min", "13s", "1h30min"])
@pytest.mark.parametrize("chunk_bars", [8, 4096])
def test_random_series_match_brute_force(trades_of, rule, chunk_bars):
    rng = random.Random(f"{rule}{chunk_bars}")
    rows, start = [], 1704067200000 + 85_000_000
    for symbol, count, spread in (("A", 120, 40_000_000), ("B", 30, 90_000_000), ("C", 1, 1)):
        for _ in range(count):
            price = rng.choice([None, float("nan"), 0.0] + [round(rng.uniform(1, 9), 2)] * 12)
            rows.append((start + rng.randrange(spread) // 7 * 7, price, float(rng.choice([0, 0, 1, 2, 5])), "buy", symbol))
    rows.append((start - 3_600_000, 2.0, 1.0, "buy", "A"))
    step = {"13s": 400}.get(rule)
    if step:
        rows = [(start + (r[0] - start) // step, *r[1:]) for r in rows]
    dicts = [dict(ts=r[0], price=r[1], qty=r[2], symbol=r[4], seq=i) for i, r in enumerate(rows)]
    got = table(bars.compute(trades_of(rows), rule, (2, 5), chunk_bars=chunk_bars))
    assert_same(got, expected_bars(dicts, rule, (2, 5)))


@pytest.mark.parametrize("rule", ["W", "W-WED", "MS", "ME", "QS", "QE", "YS", "YE", "36h"])
def test_calendar_rules_match_brute_force(trades_of, rule):
    rng = random.Random(rule)
    rows = []
    for symbol in "AB":
        for _ in range(25):
            day = rng.randrange(18_000, 18_900) * 86_400_000
            rows.append((day + rng.choice([0, 86_399_999, rng.randrange(86_400_000)]), float(rng.randrange(1, 9)), 1.0, "buy", symbol))
    dicts = [dict(ts=r[0], price=r[1], qty=r[2], symbol=r[4], seq=i) for i, r in enumerate(rows)]
    got = table(bars.compute(trades_of(rows), rule, (3,), chunk_bars=16))
    assert_same(got, expected_bars(dicts, rule, (3,)))


def test_wide_positions_keep_their_order(spark):
    # Positions beyond the packed low bits fall into several eras.
    day = 1704067200000
    rows = [("S", (1 << 61) + 5, day, 3.0, 1.0), ("S", 2, day, 1.0, 1.0), ("S", 1 << 50, day, 2.0, 1.0), ("S", 9, day + 5, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, seq bigint, ts bigint, price double, qty double")
    for rule in ("1min", "365D"):
        bar = bars.sparse_bars(df, rule).first()
        assert (bar["price_open"], bar["price_close"]) == (1.0, 4.0)
    bar = bars.sparse_bars(df.where("ts = 1704067200000"), "1min").first()
    assert (bar["price_open"], bar["price_close"]) == (1.0, 3.0)


def test_history_without_positions(spark, ten_trades, folder):
    # A plain table of ts, price, qty, side works as it is.
    ten_trades.drop("seq", "symbol").write.parquet(folder("plain"))
    plain = history.load_trades(spark, folder("plain"), "ANY", ordered=True)
    assert plain.columns == ["ts", "price", "qty", "side"]
    with_all = bars.compute(ten_trades, "1min", (3,)).drop("symbol")
    assert bars.compute(plain, "1min", (3,)).drop("symbol").exceptAll(with_all).count() == 0
    history.append(plain, folder("kept"))
    assert history.load_trades(spark, folder("kept"), "UNKNOWN").count() == 10


def test_ticks_are_read_and_shuffled_once(spark, ten_trades, folder):
    ten_trades.write.parquet(folder("t"))
    result = bars.compute(spark.read.parquet(folder("t")))
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert "SortAggregate" not in plan


def test_labels(ten_trades):
    got = labels.build_targets(bars.compute(ten_trades, "1min", (3,)), 1, 0.0).orderBy("timestamp").collect()
    assert [r["label"] for r in got] == [1, 1, 0, 0, 0, 1, 0, 1, 0]
    assert got[0]["future_return"] == pytest.approx(0.01)
    split = labels.chrono_split(labels.build_targets(bars.compute(ten_trades, "1min", (3,)), 1, 0.0))
    assert [r["is_test"] for r in split.orderBy("timestamp").collect()] == [False] * 7 + [True] * 2


@pytest.mark.parametrize("chunk_bits", [17, 20, 28])
@pytest.mark.parametrize("horizon", [1, 4])
def test_labels_across_chunks(spark, horizon, chunk_bits):
    rng = random.Random(horizon)
    rows, at = [], 1704067200000
    for symbol, n in (("A", 60), ("B", 3), ("C", 1)):
        for i in range(n):
            rows.append((symbol, at + 60_000 * i, round(rng.uniform(1, 9), 3)))
    df = spark.createDataFrame(rows, "symbol string, ms bigint, price_close double").withColumn("timestamp", F.timestamp_millis("ms"))
    got = {(r["symbol"], r["ms"]): r["future_return"] for r in labels.build_targets(df, horizon, 0.0, chunk_bits=chunk_bits).collect()}
    want = {}
    for symbol in "ABC":
        part = [r for r in rows if r[0] == symbol]
        for now, later in zip(part, part[horizon:]):
            want[symbol, now[1]] = (later[2] - now[2]) / now[2]
    assert got == want
    split = labels.chrono_split(df, chunk_bits=chunk_bits).groupBy("symbol").agg(
        F.sum(F.col("is_test").cast("int")).alias("n"), F.min(F.when(F.col("is_test"), F.col("ms"))).alias("first")
    )
    assert {r["symbol"]: (r["n"], r["first"]) for r in split.collect()} == {
        "A": (12, at + 60_000 * 48), "B": (1, at + 120_000), "C": (1, at)
    }


def test_labels_need_no_further_shuffle(spark, trades_of):
    """One explosion of the gaps and one exchange of the dense stage in the plan of labelled bars."""
    df = labels.labelled_bars(trades_of([(BASE + 60_000 * i * (1 + i % 5), 1.0 + i, 1.0) for i in range(300)]), "1min", (3,), 5)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_NUM") == 1 and "Join" not in plan


@pytest.mark.parametrize("horizon", [1, 3, 50, 390])
@pytest.mark.parametrize("rule", ["1min", "250ms"])
def test_labelled_bars_equal_targets_of_bars(spark, trades_of, horizon, rule):
    step = 60_000 if rule == "1min" else 250
    rows = [(BASE + step * (i * 7 % 400), float(1 + i % 9), 1.0, "buy", f"S{i % 2}") for i in range(200)]
    trades = trades_of(rows)
    ours = labels.labelled_bars(trades, rule, (3, 5), horizon, 0.0, chunk_bars=16)
    theirs = labels.build_targets(bars.compute(trades, rule, (3, 5)), horizon, 0.0)
    key = ["symbol", "timestamp", "price_close", "future_return", "label", "ma_5"]
    shown = lambda df: sorted((r[0], str(r[1]), *[round(x, 9) for x in r[2:]]) for r in df.select(*key).collect())
    assert shown(ours) == shown(theirs) and theirs.count() > 0


def test_a_stray_time_makes_no_giant_array(trades_of):
    trades = trades_of([(0, 1.0, 1.0), (86_400_000 * 40, 2.0, 1.0)])
    assert bars.compute(trades, "1s", (3,)).count() == 86_400 * 40 + 1


def test_chunks_of_targets_suit_the_rule():
    assert labels.chunk_bits_of("1min") == 28
    assert labels.chunk_bits_of("100ms") < 20 and labels.chunk_bits_of("100ms", 100_000) > 25
    assert labels.chunk_bits_of("ME") > 40


def test_dense_points_are_made_behind_every_sort(ten_trades):
    """Bars without a trade are most of the rows: nothing sorts, windows or explodes them."""
    df = bars.compute(ten_trades, "1min", (3,))
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert not any(word in above for word in ("Sort", "Window", "Generate", "Exchange"))


def test_dense_parts_do_not_show(monkeypatch):
    """The same bars, however many grid points are made at once and wherever a batch ends."""
    import pyarrow as pa

    told = {"symbol": [], "chunk": [], "bucket": [], "kind": []}
    values = {c: [] for c in (*bars.FILLS, "volume", "trade_count")}
    rng = random.Random(5)
    for symbol in ("A", "B", None):
        for chunk in range(3):
            for bucket in sorted(rng.sample(range(16 * chunk, 16 * chunk + 16), rng.randrange(1, 9))):
                for c, v in zip(told, (symbol, chunk, bucket, bars.BAR), strict=True):
                    told[c].append(v)
                for c in values:
                    values[c].append(float(rng.randrange(1, 9)) if c != "trade_count" else 1)
    rows = pa.table({**told, **values}).to_batches()[0]
    names = ["symbol", "bucket", "price_close", "trade_count", "return_1", "ma_3", "vol_3", "volumema_3"]

    def made(size):
        parts = [rows.slice(i, size) for i in range(0, rows.num_rows, size)]
        return pa.Table.from_batches(bars._bars_of_chunks(iter(parts), 1, 16, (3,), 0, names)).to_pylist()

    whole = made(rows.num_rows)
    assert len(whole) > rows.num_rows
    monkeypatch.setattr(bars, "MOST_POINTS", 8)
    assert all(made(size) == whole for size in (1, 2, 7, 1000))


def moved(df):
    """Rows that each exchange of a collected frame has written."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("rule", ["1min", "1D"])
def test_bars_move_once(spark, rule):
    """Trades are put together where they are read, however far apart their positions, and their bars move once."""
    step = 60_000 if rule == "1min" else 86_400_000
    rows = [(f"S{i % 3}", i << 50, 1704067200000 + step * (i // 6), 1.0 + i % 7, 1.0) for i in range(3000)]
    df = bars.compute(spark.createDataFrame(rows, "symbol string, seq bigint, ts bigint, price double, qty double"), rule, (3,))
    assert len(df.collect()) == 1500
    written = sorted(moved(df))
    assert 1500 <= written[-1] < 1600 and sum(written[:-1]) < 100


def test_dense_tasks_do_not_depend_on_sizes(trades_of):
    """With all bars in one stretch of time nothing is carried; few rows must still be shared by all tasks."""
    df = bars.compute(trades_of([(BASE + 60_000 * i, 1.0 + i, 1.0, "buy", f"S{i % 50}") for i in range(200)]), "1min", (3,))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "AQEShuffleRead" not in plan[: plan.index("ShuffleQueryStage")]


def test_partial_bars_in_any_order(monkeypatch):
    """The same bars wherever a task's trades are cut, and however their partial bars meet."""
    import pyarrow as pa

    rng = random.Random(11)
    schema = pa.schema([("symbol", pa.string()), ("bucket", pa.int64()), *((c, pa.int64() if c in bars.COUNTS else pa.float64()) for c in bars.PARTIAL)])
    rows, want = [], {}
    for i in range(400):
        price = rng.choice([None, 0.0, math.inf] + [float(rng.randrange(1, 9))] * 9)
        qty = rng.choice([None, 0.0, 1.0, 2.0, -2.0])
        row = dict.fromkeys(schema.names) | {"symbol": rng.choice("AB"), "bucket": rng.randrange(9), "price_open": price, "volume": qty or 0.0}
        row |= {"first_ts": rng.randrange(3), "first_seq": rng.choice([1, -1]) * (1 << 62) + i, "trade_count": int(price is not None)}
        rows.append(row | {"notional": 0.0 if price is None or qty is None else None})
    for row in sorted(rows, key=lambda r: (r["first_ts"], r["first_seq"])):
        bar = want.setdefault((row["symbol"], row["bucket"]), {"prices": [], "volume": 0.0, "notional": 0.0})
        bar["prices"] += [row["price_open"]] * row["trade_count"]
        bar["volume"] += row["volume"]
        bar["notional"] += row["price_open"] * row["volume"] if row["notional"] is None else 0.0

    def put(tasks):
        return pa.Table.from_batches([x for task in (tasks[::2], tasks[1::2]) for x in bars._put_together(iter(task))])

    for most, size in ((1 << 18, 200), (1 << 18, 7), (40, 10), (2, 1)):
        monkeypatch.setattr(bars, "MOST_PARTIAL", most)
        rng.shuffle(rows)
        partial = put([pa.RecordBatch.from_pylist(rows[a : a + size], schema) for a in range(0, len(rows), size)])
        assert most < 400 or partial.num_rows <= 2 * len(want)
        kinds = {c: pa.array([v] * partial.num_rows, t) for c, v, t in (("chunk", 0, pa.int64()), ("kind", bars.BAR, pa.int32()))}
        for c, v in kinds.items():
            partial = partial.append_column(c, v)
        ordered = partial.sort_by([("symbol", "ascending"), ("bucket", "ascending")]).to_batches(size)
        got = {(r["symbol"], r["bucket"]): r for r in pa.Table.from_batches(bars._merged(iter(ordered))).to_pylist()}
        assert got.keys() == want.keys()
        for key, bar in want.items():
            known, volume = bar["prices"] or [math.nan], bar["volume"]
            named = zip(bars.PRICES, (known[0], max(known), min(known), known[-1]), strict=True)
            for c, v in (*named, ("volume", volume), ("trade_count", len(bar["prices"])), ("vwap", bar["notional"] / volume if volume else math.nan)):
                np.testing.assert_allclose(got[key][c], v, err_msg=f"{key} {c}")


def test_wide_positions_keep_their_order_in_dense_bars(spark):
    day = 1704067200000
    rows = [("S", (1 << 61) + 5, day, 3.0, 1.0), ("S", 2, day, 1.0, 1.0), ("S", 1 << 50, day, 2.0, 1.0), ("S", -7, day, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, seq bigint, ts bigint, price double, qty double").repartition(3)
    bar = bars.compute(df, "1min", (2,)).first()
    assert (bar["price_open"], bar["price_close"], bar["price_high"], bar["trade_count"]) == (4.0, 3.0, 4.0, 4)
