import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sample_times import BASE
from tapeloom.operators import backtest, correlation, quantiles
from tapeloom.sources import raw
from tapeloom.streaming import monitor


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(8)
    rows = [("hot", rng.choice([rng.gauss(0, 1e6), rng.expovariate(1), 0.0, -3.5])) for _ in range(4000)]
    rows += [("two", 1.0), ("two", 2.0), ("one", -7.25), (None, 5.0), (None, math.nan), ("nothing", None), ("nothing", math.inf), ("zeros", 0.0), ("zeros", 0.0)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(6)


def by_group(rows):
    kept = {}
    for g, v in rows:
        if v is not None and math.isfinite(v):
            kept.setdefault(g, []).append(v)
    return kept


def test_exact_quantiles(numbers):
    rows, df = numbers
    asked = (0.0, 0.1, 0.5, 0.95, 1.0)
    got = {(r.g, r.probability): r.value for r in quantiles.exact(df, ["g"], "v", asked).collect()}
    want = {(g, p): float(np.quantile(v, p)) for g, v in by_group(rows).items() for p in asked}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


@pytest.mark.parametrize("accuracy", [0.001, 0.01, 0.2])
def test_sketches_keep_their_error_and_merge(numbers, accuracy):
    rows, df = numbers
    whole = quantiles.sketch(df, ["g"], "v", accuracy)
    parts = [quantiles.sketch(df.where(F.pmod(F.hash("v"), F.lit(3)) == i), ["g"], "v", accuracy) for i in range(3)]
    merged = quantiles.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g"])
    assert sorted(merged.collect(), key=str) == sorted(whole.collect(), key=str)
    for r in quantiles.estimated(merged, ["g"], (0.0, 0.5, 0.95, 1.0), accuracy).collect():
        own = sorted(by_group(rows)[r.g])
        true = own[math.floor(r.probability * (len(own) - 1))]
        assert abs(r.value - true) <= accuracy * abs(true) * (1 + 1e-9)


def test_extreme_values_and_refusals(spark):
    df = spark.createDataFrame([(5e-324,), (1.7e308,), (-1.7e308,), (0.0,)], "v double")
    assert [r.value for r in quantiles.exact(df, [], "v", (0.0, 1.0)).orderBy("probability").collect()] == [-1.7e308, 1.7e308]
    with pytest.raises(ValueError, match="accuracy"):
        quantiles.sketch(df, [], "v", 1.0)
    with pytest.raises(ValueError, match="probabilities"):
        quantiles.exact(df, [], "v", (1.5,))


def curve(earned):
    """Equity and drawdown step by step."""
    out, equity, peak = [], 1.0, 1.0
    for r in earned:
        equity *= 1 + (r or 0.0)
        peak = max(peak, equity)
        out.append((equity, equity / peak - 1))
    return out


@pytest.mark.parametrize("bits", [28, 4, 1])
def test_equity_over_chunks_equals_a_walk(spark, bits):
    rng = random.Random(bits)
    series = {"A": [rng.uniform(-0.3, 0.33) for _ in range(200)], "B": [-0.5, 0.1, None, 2.0], "C": [0.1, -1.0, 0.5]}
    rows = [(s, BASE + 3 * i, r) for s, v in series.items() for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "symbol string, at long, earned double").select("symbol", F.timestamp_millis("at").alias("timestamp"), "earned").repartition(5)
    got = backtest.equity(df, chunk_bits=bits).orderBy("symbol", "timestamp").collect()
    want = [x for s in sorted(series) for x in curve(series[s])]
    assert np.allclose([(r.equity, r.drawdown) for r in got], want, rtol=1e-9, atol=1e-12)


def test_returns_cost_and_summary(spark):
    rows = [("A", 1, 0.5, 1.0), ("A", 2, -0.5, -1.0), ("A", 3, math.inf, 1.0), ("A", 4, None, 1.0), ("A", 5, 0.2, None)]
    df = spark.createDataFrame(rows, "symbol string, at long, future_return double, p double").withColumn("timestamp", F.timestamp_millis("at"))
    made = backtest.strategy_returns(df, F.col("p"), cost=0.1, stake=0.5)
    assert [round(r.earned, 9) for r in made.orderBy("at").collect()] == [0.2, 0.2, -0.05, -0.05, 0.0]
    found = backtest.summary(backtest.equity(made)).first()
    assert (found.bars, found.trades, found.wins) == (5, 4, 2)
    assert math.isclose(found.final_equity, 1.2 * 1.2 * 0.95 * 0.95) and math.isclose(found.worst_drawdown, 0.95 * 0.95 - 1)
    assert backtest.summary(backtest.equity(made.where("false"))).collect() == []


@pytest.mark.parametrize("block", [64, 2, 1])
def test_correlations_against_pandas(spark, block):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        base = rng.gauss(0, 1)
        for s in "ABCDE":
            if rng.random() < 0.8 and not (s == "E" and i < 60):
                value = {"A": base, "B": base + rng.gauss(0, 0.5), "C": 1e6 + rng.gauss(0, 1), "D": 4.0, "E": -base}[s]
                rows.append((s, BASE + 1000 * i, value if i != 7 else math.inf if s == "A" else math.nan))
    df = spark.createDataFrame(rows, "symbol string, at long, return_1 double").select("symbol", F.timestamp_millis("at").alias("timestamp"), "return_1").repartition(4)
    got = {(r.window, r.symbol, r.other): (r.n, r.correlation) for r in correlation.correlations(df, 60_000, block=block).collect()}
    frame = pd.DataFrame(rows, columns=["s", "at", "v"])
    frame = frame[np.isfinite(frame["v"])].assign(window=lambda f: f["at"] - f["at"] % 60_000)
    want = {}
    for window, part in frame.groupby("window"):
        wide = part.pivot(index="at", columns="s", values="v")
        for a in wide.columns:
            for b in wide.columns:
                both = wide[[a, b]].dropna() if a < b else []
                if len(both):
                    flat = len(both) < 2 or both[a].std() < 1e-9 or both[b].std() < 1e-9
                    want[window, a, b] = (len(both), None if flat else both[a].corr(both[b]))
    assert got.keys() == want.keys()
    for key, (n, value) in want.items():
        assert got[key][0] == n
        assert (got[key][1] is None) == (value is None) and (value is None or abs(got[key][1] - value) < 1e-6)
    assert correlation.correlations(df.where("false"), 60_000).collect() == []


def test_throughput_and_latency_of_a_stream(spark, folder):
    seq = F.col("id")
    ticks = spark.range(600).select(
        F.when(seq % 4 == 0, "B").otherwise("A").alias("symbol"), (BASE + seq * 130 + F.when(seq > 300, 5_000_000).otherwise(0)).alias("ts"), (seq % 50 * 3.0).alias("late")
    )
    for i in range(6):
        ticks.where(F.pmod(F.floor((F.col("ts") - BASE) / 13000), F.lit(6)) == i).coalesce(1).write.mode("append").parquet(folder("ticks"))
    source = lambda: raw.stream_frames(spark, folder("ticks"), ticks.schema, max_files_per_trigger=1)
    query = monitor.start_throughput(source(), folder("out"), folder("cp"), delay="3 hours")
    query.awaitTermination()
    got = {(r.symbol, r.second): r.n for r in monitor.read_throughput(spark, folder("out")).collect()}
    want = {}
    for r in ticks.collect():
        want[r.symbol, r.ts - r.ts % 1000] = want.get((r.symbol, r.ts - r.ts % 1000), 0) + 1
    assert {k: n for k, n in got.items() if n} == want
    for symbol in "AB":
        seconds = sorted(s for x, s in got if x == symbol)
        assert seconds == list(range(seconds[0], seconds[-1] + 1000, 1000)) and len(seconds) > 5000
    observed = [p["observedMetrics"]["ticks"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(o["rows"] for o in observed) == 600
    late = monitor.start_latency(source(), F.col("late"), folder("lat"), folder("cp2"), window_ms=10_000_000)
    late.awaitTermination()
    told = monitor.read_latency(spark, folder("lat"))
    exact = quantiles.estimated(quantiles.sketch(ticks.withColumn("window", F.col("ts") - F.col("ts") % 10_000_000), ["window"], "late"), ["window"])
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, exact.collect()))
