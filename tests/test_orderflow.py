import random

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import orderflow, ordered, recent

from sample_times import BASE


def brute(rows, size=100):
    """OFI by symbol and position from plain slices."""
    want = {}
    for symbol in {r[0] for r in rows}:
        part = sorted((r[1], r[2]) for r in rows if r[0] == symbol)
        for i, (seq, _) in enumerate(part):
            sides = [s for _, s in part[max(0, i - size + 1) : i + 1]]
            buys, sells = sides.count("buy"), sides.count("sell")
            want[symbol, seq] = (buys - sells) / ((buys + sells) or 1)
    return want


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(3)
    rows, seq = [], 0
    for _ in range(1500):
        seq += rng.choice([1, 1, 1, 2, 700])
        rows.append((rng.choice("AAAAB") if seq % 50 else "C", seq, rng.choice(["buy", "sell", "other"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, seq bigint, side string").withColumn("ts", F.col("seq") * 10)


def test_first_trades(ten_trades):
    got = [r["ofi"] for r in orderflow.imbalance(ten_trades).orderBy("seq").collect()]
    assert got == [1, 0, 1 / 3, 0, 1 / 5, 0, 1 / 7, 0, 1 / 9, 0]


def test_other_sides_fill_a_slot(spark):
    df = frame(spark, [("A", 0, "buy"), ("A", 1, "other"), ("A", 2, "other")])
    got = [r["ofi"] for r in orderflow.imbalance(df, 2).orderBy("seq").collect()]
    assert got == [1.0, 1.0, 0.0]


@pytest.mark.parametrize("chunk_bits", [3, 7, 10, 18])
@pytest.mark.parametrize("form", [orderflow.imbalance, orderflow.imbalance_by_chunks])
def test_chunked_forms_match_brute_force(spark, random_rows, form, chunk_bits):
    got = {(r["symbol"], r["seq"]): r["ofi"] for r in form(frame(spark, random_rows), chunk_bits=chunk_bits).collect()}
    assert got == brute(random_rows)


def test_small_window(spark, random_rows):
    got = {(r["symbol"], r["seq"]): r["ofi"] for r in orderflow.imbalance(frame(spark, random_rows), 1, chunk_bits=4).collect()}
    assert got == brute(random_rows, 1)


def test_no_task_holds_a_whole_symbol(spark):
    # One symbol only: its rows still spread over chunks, so no window is keyed
    # by the symbol alone except the last one over chunk edges.
    df = spark.range(1000).select(F.lit("A").alias("symbol"), F.col("id").alias("seq"), F.lit("buy").alias("side"), F.col("id").alias("ts"))
    plan = orderflow.imbalance(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in plan.split("Window")[1]


def test_running_sums(spark, random_rows):
    df = frame(spark, random_rows)
    got = ordered.running(df, ["symbol"], "seq", {"n": F.lit(1).cast("bigint")}, chunk_bits=6)
    for symbol in "ABC":
        part = sorted(r[1] for r in random_rows if r[0] == symbol)
        mine = [r["n"] for r in got.where(F.col("symbol") == symbol).orderBy("seq").collect()]
        assert mine == list(range(1, len(part) + 1))


def test_latest_rows(spark, random_rows):
    df = frame(spark, random_rows)
    got = {(r["symbol"], r["seq"]) for r in recent.last_trades(df, 30).collect()}
    want = set()
    for symbol in "ABC":
        want |= {(symbol, s) for s in sorted(r[1] for r in random_rows if r[0] == symbol)[-30:]}
    assert got == want


def loop_axis(part):
    last, out = 0, {}
    for ts, seq in sorted(part):
        own = ts // 1000
        last = own if own > last else last + 1
        out[seq] = last
    return out


@pytest.mark.parametrize("chunk_bits,seq_bits", [(10, 2), (13, 5), (22, 18)])
def test_axis_matches_the_loop(spark, chunk_bits, seq_bits):
    rng = random.Random(11)
    rows = []
    for seq in range(600):
        # Long stretches of the same second, bursts, and jumps; first times at zero.
        ts = rng.choice([0, 5, 900, 1000, 1001, 7000, 7000, 7000, 7999, rng.randrange(90_000), rng.randrange(2_000_000)])
        rows.append((rng.choice(["A", "A", "B"]), seq, ts, 1.0))
    df = spark.createDataFrame(rows, "symbol string, seq bigint, ts bigint, price double")
    got = recent.monotone_axis(df, chunk_bits=chunk_bits, seq_bits=seq_bits).collect()
    for symbol in "AB":
        mine = {r["seq"]: r["axis"] for r in got if r["symbol"] == symbol}
        assert mine == loop_axis([(r[2], r[1]) for r in rows if r[0] == symbol])


def test_feed_ticker_and_portfolio(spark, trades_of):
    trades = trades_of([(BASE, 64000.0, 0.01, "buy"), (BASE + 1000, 64010.0, 0.02, "sell"), (BASE + 2000, 64005.0, 0.03, "buy")])
    feed = recent.trade_feed(trades).orderBy("position").collect()
    assert [r["price_text"] for r in feed] == ["$64,005", "$64,010", "$64,000"]
    assert feed[0]["time_text"] == "22:13:22" and feed[0]["qty_text"] == "0.030000"
    summary = recent.summary(trades).first()
    assert summary["last_price"] == 64005.0 and summary["change_pct"] == pytest.approx(0.0078125)
    assert recent.latest_trade(trades).first()["seq"] == 2
    shown = spark.createDataFrame([("A", 64000.42, 1.23), ("B", None, 0.0)], "symbol string, last_price double, change_pct double")
    assert [tuple(r)[1:] for r in recent.ticker(shown).orderBy("symbol").collect()] == [("$64,000.42", "+1.23%"), ("—", "—")]
    zero = recent.summary(trades_of([(BASE, 0.0, 1.0), (BASE + 1, 5.0, 1.0)])).first()
    assert zero["change_pct"] == 0.0
    held = spark.createDataFrame([("BTC", 0.5, 32000.0), ("ETH", 4.0, 12500.0), ("SOL", 120.0, 18000.0)], "symbol string, quantity double, value double")
    assert recent.portfolio_total(held).first()[0] == 62500.0
    assert recent.portfolio_total(held.limit(0)).first()[0] == 0.0
    assert recent.portfolio_lines(held).first()["value_text"] == "$32,000"
