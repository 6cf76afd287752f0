import pytest
from pyspark.sql import functions as F

from sample_times import BASE
from tapeloom.operators import bars
from tapeloom.sources import raw
from tapeloom.streaming import accuracy, volatility

MINUTE = 60_000


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def landed(df, path, by, steps):
    """The frame in files of consecutive times, written one after the other."""
    low, high = df.agg(F.min(by), F.max(by)).first()
    for i in range(steps):
        begin = low + (high - low + 1) * i // steps
        end = low + (high - low + 1) * (i + 1) // steps
        df.where((F.col(by) >= begin) & (F.col(by) < end)).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def ticks(spark):
    """Two symbols, quiet hours, a zero price, trades without a price."""
    seq = F.col("id")
    at = BASE + seq * 7001 + F.when(seq > 400, 3_600_000 * 5).otherwise(0)
    price = F.when(seq == 90, 0.0).when(seq % 41 == 5, None).otherwise(100 + (seq * seq) % 37)
    return spark.range(800).select(
        F.when(seq % 3 == 0, "B").otherwise("A").alias("symbol"), seq.alias("seq"), at.cast("bigint").alias("ts"),
        price.cast("double").alias("price"), F.lit(1.0).alias("qty"), F.when(seq % 2 == 0, "buy").otherwise("sell").alias("side"),
    ).persist()


@pytest.mark.parametrize("files", [1, 7])
def test_live_volatility_equals_that_of_batch_bars(spark, ticks, folder, files):
    source = raw.stream_frames(spark, landed(ticks, folder("ticks"), "ts", files), ticks.schema, max_files_per_trigger=1)
    run(volatility.start(source, folder("out"), folder("cp"), rule="1min", windows=(3, 5), delay="2 minutes"))
    live = spark.read.parquet(folder("out"))
    newest = ticks.agg(F.max("ts")).first()[0] - 2 * MINUTE
    # Empty bars behind a symbol's last closed bar with a trade wait for its next trade.
    priced = ticks.where("price IS NOT NULL").withColumn("bucket", F.col("ts") - F.col("ts") % MINUTE).where(F.col("bucket") + MINUTE <= newest)
    last = priced.groupBy("symbol").agg(F.max("bucket").alias("last"))
    made = bars.compute(ticks, "1min", (3, 5)).withColumn("bucket", F.unix_millis("timestamp")).join(last, "symbol").where("bucket <= last")
    keep = ["symbol", "bucket", "price_close", "return_1", *[F.round(F.col(c), 9).alias(c) for c in ("vol_3", "vol_5")]]
    got, want = (sorted(map(tuple, df.select(*keep).collect())) for df in (live, made))
    assert got == want and len(got) > 300
    assert live.where("return_1 = double('Infinity')").count() == 1


def test_late_trades_are_in_no_bar(spark, ticks, folder):
    path = landed(ticks, folder("ticks"), "ts", 4)
    late = ticks.limit(1).withColumns({"price": F.lit(1e9), "ts": F.lit(BASE)})
    late.write.mode("append").parquet(path)
    source = raw.stream_frames(spark, path, ticks.schema, max_files_per_trigger=1)
    run(volatility.start(source, folder("out"), folder("cp"), rule="1min", delay="2 minutes"))
    assert spark.read.parquet(folder("out")).where("price_close > 1e8").isEmpty()
    with pytest.raises(ValueError, match="one grid"):
        volatility.closed_bars(ticks, "7min", "1 minute")


def test_stream_accuracy_equals_the_batch_join_with_bounded_state(spark, ticks, folder):
    scored = ticks.select("symbol", "ts", (F.col("seq") % 10 / 10).alias("prob_up"))
    known = ticks.select("symbol", (F.col("ts") - F.col("ts") % MINUTE).alias("bucket")).distinct().withColumn("label", (F.col("bucket") / MINUTE % 3 == 0).cast("int"))
    # Labels of every fifth bar never come.
    known = known.where(F.col("bucket") / MINUTE % 5 != 0).persist()
    streams = [raw.stream_frames(spark, landed(df, folder(n), by, 12), df.schema, max_files_per_trigger=1) for df, n, by in ((scored, "scored", "ts"), (known, "labels", "bucket"))]
    query = accuracy.start(*streams, folder("out"), folder("cp"), rule="1min", horizon=2, window_ms=10 * MINUTE, delay="10 minutes")
    kept = []
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    want = accuracy.accuracy(accuracy.counted(accuracy.judged(scored, known, "1min", 2), 10 * MINUTE))
    got = accuracy.read(spark, folder("out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.sum("n")).first()[0] == scored.withColumn("bucket", F.col("ts") - F.col("ts") % MINUTE).join(known, ["symbol", "bucket"]).count()
    # What waits is what the delay and the horizon span, not all that came.
    assert max(kept) < (scored.count() + known.count()) / 2 and kept[-1] < 250


def test_hits(spark):
    scored = spark.createDataFrame([("A", BASE, 0.5), ("A", BASE + 1, 0.49), ("A", BASE + MINUTE, 0.9), (None, BASE, 0.9)], "symbol string, ts bigint, prob_up double")
    known = spark.createDataFrame([("A", BASE - BASE % MINUTE, 1), (None, BASE - BASE % MINUTE, 1)], "symbol string, bucket bigint, label int")
    assert sorted((r.ts - BASE, r.hit) for r in accuracy.judged(scored, known, "1min").collect()) == [(0, True), (1, False)]


def test_accuracy_keeps_bars_not_trades(spark, folder):
    """Many trades of few bars: the join's state holds bars and labels; windows that cut a bar, no forecast and no label count as before."""
    i = F.col("id")
    scored = spark.range(4000).select(
        F.when(i % 4 == 0, "B").otherwise("A").alias("symbol"), (BASE - BASE % MINUTE + i * 37).alias("ts"),
        F.when(i % 7 != 0, i % 10 / 10).alias("prob_up"),
    ).persist()
    known = scored.select("symbol", (F.col("ts") - F.col("ts") % MINUTE).alias("bucket")).distinct().withColumn("label", F.when(F.col("symbol") == "A", 1))
    paths = {"scored": scored, "labels": known}
    for name, df in paths.items():
        df.write.parquet(folder(name))
    streams = [raw.stream_frames(spark, folder(n), df.schema) for n, df in paths.items()]
    query = accuracy.start(*streams, folder("out"), folder("cp"), rule="1min", window_ms=90_000)
    run(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) <= 4 * known.count() < 40
    want = accuracy.accuracy(accuracy.counted(accuracy.judged(scored, known, "1min"), 90_000))
    got = sorted(map(str, accuracy.read(spark, folder("out")).collect()))
    assert got == sorted(map(str, want.collect())) and len(got) > 2
