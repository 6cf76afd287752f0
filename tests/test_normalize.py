import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sample_times import BASE
from tapeloom.operators import normalize
from tapeloom.sources import history
from tapeloom.streaming import replay


def frames(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "seq bigint, value string")


def by_seq(df, *columns):
    return {r["seq"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_normalize_sample_messages(spark):
    trades, rejects = normalize.normalize(
        frames(
            spark,
            [
                '{"T": 1700000000000, "p": "64000.42", "q": "0.012", "m": false}',
                '{"T": 1700000000100, "p": "64001.0", "q": "0.5", "m": true}',
            ],
        )
    )
    assert by_seq(trades, "ts", "price", "qty", "side") == {
        0: (1700000000000, 64000.42, 0.012, "buy"),
        1: (1700000000100, 64001.0, 0.5, "sell"),
    }
    assert rejects.count() == 0


def test_normalize_edge_messages(spark):
    good = [
        '{"T":1,"p":"1","q":"1","m":0}',
        '{"T":1,"p":"1","q":"1","m":0.0}',
        '{"T":1,"p":"1","q":"1","m":null}',
        '{"T":1,"p":"1","q":"1","m":"false"}',
        '{"T":1,"p":"1_000","q":" 2.5 ","m":false}',
        '{"T":1,"p":3,"q":"nan","m":1}',
        '{"T":1,"p":"1","q":"1","m":"0"}',
        '{"T":1,"p":"1","q":"1","m":[]}',
    ]
    trades, rejects = normalize.normalize(frames(spark, good))
    sides = {s: v[0] for s, v in by_seq(trades, "side").items()}
    assert sides == {0: "buy", 1: "buy", 2: "sell", 3: "sell", 4: "buy", 5: "sell", 6: "sell", 7: "sell"}
    assert by_seq(trades, "price", "qty")[4] == (1000.0, 2.5)
    assert str(by_seq(trades, "qty")[5][0]) == "nan"
    assert rejects.count() == 0

    bad = [
        "{oops", '{"T":1,"p":"1","q":"1"}', '{"T":1,"p":"abc","q":"1","m":true}', '{"p":"1","q":"1","m":true}',
        '{"T":1,"p":"1","q":"1.0d","m":true}', None,
    ]
    trades, rejects = normalize.normalize(frames(spark, bad))
    assert trades.count() == 0
    assert by_seq(rejects, "reason") == {
        0: ("not json",), 1: ("missing m",), 2: ("bad price",), 3: ("missing T",), 4: ("bad qty",), 5: ("not json",),
    }
    assert by_seq(rejects, "value")[2] == (bad[2],)


def test_strict_mode_stops(spark):
    ok = frames(spark, ['{"T":1,"p":"1","q":"1","m":true}'])
    assert normalize.normalize_strict(ok).count() == 1
    with pytest.raises(PySparkException, match="not json"):
        normalize.normalize_strict(frames(spark, ["{"])).collect()


def test_one_parse_per_message(spark):
    plan = normalize.normalize(frames(spark, ["{}"]))[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_dialects(spark):
    texts = [
        '{"id":"1-0","ts":5,"price":10.5,"qty":2,"side":"buy"}',
        '{"T":6,"p":"11","q":"3","m":false}',
        '{"T":6,"p":"11","q":"3","m":0}',
        '{"ts":null,"T":7,"price":"12","q":"0x10","side":"SELL"}',
        '{"ts":8,"price":"abc","qty":1}',
        '{"ts":8,"price":1}',
        "nope",
        '{"ts":9,"p":null,"qty":"","side":"sell"}',
        '{"ts":9,"p":true,"qty":"Infinity","side":"buy"}',
        '{"ts":9,"p":"true","qty":1}',
    ]
    got = by_seq(normalize.normalize_dialects(frames(spark, texts)), "ts", "price", "qty", "side")
    assert got == {
        0: (5, 10.5, 2.0, "buy"),
        1: (6, 11.0, 3.0, "buy"),
        2: (6, 11.0, 3.0, "sell"),
        3: (7, 12.0, 16.0, "sell"),
        7: (9, 0.0, 0.0, "sell"),
        8: (9, 1.0, float("inf"), "buy"),
    }
    ids = by_seq(normalize.normalize_dialects(frames(spark, texts[:2])), "id")
    assert ids == {0: ("1-0",), 1: ("6-3-11-1",)}


def test_coerce_defaults_only_for_absent_fields(spark):
    rows = [
        ("1-0", {"ts": "1700000000000", "price": "64000.0", "qty": "0.01", "side": "buy"}),
        ("1-1", {"price": "1e3", "side": "x", "ofi": "-0.4"}),
        ("1-2", {}),
    ]
    df = spark.createDataFrame(rows, "id string, fields map<string,string>")
    got = {r["id"]: tuple(r)[1:] for r in normalize.coerce_fields(df).collect()}
    assert got == {
        "1-0": (1700000000000, 64000.0, 0.01, "buy", 0.0),
        "1-1": (0, 1000.0, 0.0, "x", -0.4),
        "1-2": (0, 0.0, 0.0, "buy", 0.0),
    }
    bad = spark.createDataFrame([("1-3", {"price": "abc"})], "id string, fields map<string,string>")
    with pytest.raises(PySparkException, match="bad price"):
        normalize.coerce_fields(bad).collect()


def test_replay_text_and_bounds(spark, trades_of):
    trades = trades_of(
        [
            (1700000005000, 10000000.0, 1e-05, "sell"),
            (1700000000000, 64000.0, 0.01, "buy"),
            (1700000001000, 64010.0, 0.0002, "sell"),
            (1700000005001, 1.0, 1.0, "sell"),
            (1699999999999, 1.0, 1.0, "sell"),
            (1700000001000, 64011.0, 0.015, "buy"),
        ]
    )
    chosen = history.replay_range(trades, 1700000000000, 1700000005000)
    assert [r["seq"] for r in chosen.collect()] == [1, 2, 5, 0]
    texts = [tuple(r) for r in history.replay_entries(chosen).select("ts", "price", "qty", "side").collect()]
    assert texts == [
        ("1700000000000", "64000.0", "0.01", "buy"),
        ("1700000001000", "64010.0", "0.0002", "sell"),
        ("1700000001000", "64011.0", "0.015", "buy"),
        ("1700000005000", "10000000.0", "1e-05", "sell"),
    ]
    back = replay.received(history.replay_entries(chosen))
    assert back.select(*trades.columns).exceptAll(trades).count() == 0


def test_symbol_is_optional(spark):
    df = spark.createDataFrame([(1, 5, 1.0, 1.0, "buy")], "seq bigint, ts bigint, price double, qty double, side string")
    assert history.select_trades(df, "ANY").count() == 1
    with_symbol = df.withColumn("symbol", F.lit("btc"))
    assert history.select_trades(with_symbol, "BTC").count() == 0
    assert history.select_trades(with_symbol, "btc", 5, 5).count() == 1


def test_replay_positions_of_a_busy_millisecond(spark):
    rows = [(s, q, BASE + (0 if q % 3 else q), 1.0, 1.0, "buy") for s in ("A", "B") for q in range(60)]
    rows += [("A", None, BASE, 1.0, 1.0, "sell"), ("A", -5, BASE, 1.0, 1.0, "sell"), ("B", 1 << 40, BASE + 7, 1.0, 1.0, "sell"), ("A", 3, BASE - 1, 1.0, 1.0, "sell")]
    trades = spark.createDataFrame(rows, "symbol string, seq bigint, ts bigint, price double, qty double, side string").repartition(5)
    want = sorted((r for r in rows if BASE <= r[2] <= BASE + 50), key=lambda r: (r[2], r[1] is not None, r[1] or 0, r[0]))
    for chunk_bits, seq_bits in ((18, 22), (2, 2), (0, 0)):
        got = history.replay_range(trades, BASE, BASE + 50, chunk_bits=chunk_bits, seq_bits=seq_bits).collect()
        assert [r.position for r in got] == list(range(1, len(want) + 1))
        assert [(r.symbol, r.seq, r.ts) for r in got] == [(r[0], r[1], r[2]) for r in want]
