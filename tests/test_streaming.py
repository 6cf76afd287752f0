import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import normalize, orderflow, scoring
from tapeloom.plans import run_stream
from tapeloom.sources import history, models, paths, raw
from tapeloom.streaming import ingest, replay, tail
from tapeloom.streaming import orderflow as orderflow_stream
from tapeloom.streaming import scoring as scoring_stream

KEY = ["symbol", "seq", "ts", "ofi"]


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def frames(spark, begin, end):
    """Frames with alternating sides in uneven runs; every 17th is broken."""
    seq = F.col("id")
    text = F.format_string(
        '{"T":%d,"p":"%s","q":"0.5","m":%s}',
        seq * 250 + 1700000000000,
        (seq % 40 + 100).cast("string"),
        F.when(F.pmod(seq * seq, F.lit(7)) < 3, "true").otherwise("false"),
    )
    return spark.range(begin, end, numPartitions=1).select(
        seq.alias("seq"), F.when(seq % 17 == 0, "{broken").otherwise(text).alias("value")
    )


@pytest.fixture()
def landed(spark, folder):
    """Lands frames 0..300 in three files."""
    for begin in (0, 100, 200):
        frames(spark, begin, begin + 100).write.mode("append").parquet(folder("raw"))
    return folder("raw")


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def ingest_all(spark, folder, landed):
    source = raw.stream_frames(spark, landed, max_files_per_trigger=1)
    run(
        ingest.start(
            source, folder("log"), folder("past"), folder("cp-ingest"), rejects_path=folder("bad"), symbol="BTCUSDT"
        )
    )


def trades(spark, folder):
    return normalize.normalize(raw.read_frames(spark, folder("raw")))[0].withColumn("symbol", F.lit("BTCUSDT"))


def test_ingest_fans_out_and_restarts_without_duplicates(spark, folder, landed):
    ingest_all(spark, folder, landed)
    want = trades(spark, folder).select("seq", "ts", "price", "qty", "side", "symbol")
    log = spark.read.option("recursiveFileLookup", "true").parquet(folder("log"))
    assert same(log.select(*want.columns), want)
    assert same(history.load_trades(spark, folder("past"), "BTCUSDT"), want)
    assert spark.read.parquet(folder("bad")).count() == 300 - want.count()
    frames(spark, 300, 350).write.mode("append").parquet(landed)
    ingest_all(spark, folder, landed)
    want = trades(spark, folder).select(*want.columns)
    assert same(history.load_trades(spark, folder("past"), "BTCUSDT"), want)
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder("log")).count() == want.count()


def test_repeated_batch_changes_nothing(spark, folder, landed):
    batch = raw.read_frames(spark, landed)
    for _ in range(2):
        ingest.fan_out(batch, 4, folder("log"), folder("past"), drop_rejects=True)
    expected = normalize.normalize(batch)[0].count()
    assert spark.read.parquet(folder("log")).count() == expected
    assert history.load_trades(spark, folder("past")).count() == expected


def test_orderflow_stream_equals_batch(spark, folder, landed):
    ingest_all(spark, folder, landed)
    want = orderflow.imbalance(trades(spark, folder)).select(*KEY)
    log = lambda: raw.stream_trades(spark, folder("log"), max_files_per_trigger=1)
    run(orderflow_stream.start(log(), folder("ofi"), folder("cp-ofi")))
    assert same(spark.read.parquet(folder("ofi")).select(*KEY), want)
    run(orderflow_stream.start_stateful(log(), folder("ofi2"), folder("cp-ofi2")))
    assert same(spark.read.parquet(folder("ofi2")).select(*KEY), want)
    # Restart with more data goes on from the kept trades.
    frames(spark, 300, 420).write.mode("append").parquet(landed)
    ingest_all(spark, folder, landed)
    want = orderflow.imbalance(trades(spark, folder)).select(*KEY)
    run(orderflow_stream.start(log(), folder("ofi"), folder("cp-ofi")))
    assert same(spark.read.parquet(folder("ofi")).select(*KEY), want)
    run(orderflow_stream.start_stateful(log(), folder("ofi2"), folder("cp-ofi2")))
    assert same(spark.read.parquet(folder("ofi2")).select(*KEY), want)


def test_orderflow_batch_can_be_repeated(spark, folder):
    df = spark.range(250).select(F.lit("A").alias("symbol"), F.col("id").alias("seq"), F.col("id").alias("ts"), F.lit("buy").alias("side"))
    df = df.withColumn("side", F.when(F.col("seq") % 3 == 0, "sell").otherwise("buy"))
    first, second = df.where("seq < 130"), df.where("seq >= 130")
    orderflow_stream.micro_batch(first, 0, folder("o"), folder("s"))
    for _ in range(2):
        orderflow_stream.micro_batch(second, 1, folder("o"), folder("s"))
    assert same(spark.read.parquet(folder("o")).select(*KEY), orderflow.imbalance(df).select(*KEY))
    assert spark.read.parquet(folder("s") + "/batch=1").count() == 99
    with pytest.raises(FileNotFoundError):
        orderflow_stream.micro_batch(second, 7, folder("o"), folder("s"))


def test_score_stream(spark, folder, landed):
    ingest_all(spark, folder, landed)
    source = raw.stream_trades(spark, folder("log"), max_files_per_trigger=1)
    run(scoring_stream.start(scoring_stream.entries_of(source), folder("scored"), folder("cp-s")))
    got = [json.loads(r["value"]) for r in spark.read.text(folder("scored")).collect()]
    want = scoring.payload(scoring_stream.entries_of(trades(spark, folder))).collect()
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in want)
    assert all(0 <= g["prob_up"] <= 1 and g["predictor"] == "heuristic" for g in got)


def test_score_stream_picks_up_a_new_model(spark, folder, landed):
    from tapeloom.operators import training

    ingest_all(spark, folder, landed)

    def go():
        source = raw.stream_trades(spark, folder("log"))
        run(scoring_stream.start(scoring_stream.entries_of(source), folder("scored"), folder("cp-s"), model_path=folder("model")))
        return {json.loads(r["value"])["predictor"] for r in spark.read.option("recursiveFileLookup", "true").text(folder("scored")).collect()}

    assert go() == {"heuristic"}
    data = spark.range(100).select(F.timestamp_millis(F.col("id") * 60000).alias("timestamp"), (F.col("id") % 7).cast("double").alias("price"), (F.col("id") % 2).cast("int").alias("label"))
    models.save_model(spark, training.train(data, ("price",))[0], folder("model"), {})
    frames(spark, 300, 350).write.mode("append").parquet(landed)
    ingest_all(spark, folder, landed)
    assert go() == {"heuristic", "model"}


def test_replay_gives_the_live_features(spark, folder, landed):
    ingest_all(spark, folder, landed)
    begin, end = 1700000000000, 1700000000000 + 250 * 299
    live = orderflow.imbalance(trades(spark, folder)).select(*KEY)
    past = history.load_trades(spark, folder("past"))
    replay.publish(past, begin, end, folder("again"))
    assert same(orderflow.imbalance(replay.received(spark.read.parquet(folder("again")))).select(*KEY), live)
    run_stream.main(
        ["replay", folder("past"), folder("again2"), "--start-ts", str(begin), "--end-ts", str(end)],
        spark,
    )
    assert same(spark.read.parquet(folder("again2")), spark.read.parquet(folder("again")))


def test_independent_consumers_see_the_whole_log(spark, folder, landed):
    ingest_all(spark, folder, landed)
    total = trades(spark, folder).count()
    for name in ("one", "two"):
        seen = []
        source = raw.stream_trades(spark, folder("log"), max_files_per_trigger=1)
        run(tail.tail(source, folder(f"cp-{name}"), lambda batch, _: seen.append(batch.count())))
        assert sum(seen) == total and len(seen) == 3


def test_jobs_run_streams(spark, folder, landed):
    run_stream.main(["ingest", landed, folder("log"), folder("past"), "--checkpoint", folder("c1"), "--symbol", "ETH", "--drop-rejects"], spark)
    run_stream.main(["orderflow", folder("log"), folder("ofi"), "--checkpoint", folder("c2")], spark)
    run_stream.main(["score", folder("log"), folder("scored"), "--checkpoint", folder("c3")], spark)
    n = history.load_trades(spark, folder("past"), "ETH").count()
    assert n == spark.read.parquet(folder("ofi")).count() == spark.read.text(folder("scored")).count() > 0


def test_history_layout(spark, folder, trades_of):
    day = 86_400_000
    rows = [(day * i + 5, 1.0 + i, 1.0, "buy", "007" if i % 2 else "BTC") for i in range(6)]
    history.append(trades_of(rows), folder("past"))
    history.append(trades_of([(day * 2, 9.0, 1.0, "sell", "BTC")]), folder("past"))
    history.append_batch(trades_of([(day * 9, 9.0, 1.0, "sell", "BTC")]), folder("past"), 3)
    loaded = history.load_trades(spark, folder("past"), "007")
    assert sorted(r["price"] for r in loaded.collect()) == [2.0, 4.0, 6.0]
    bounded = history.load_trades(spark, folder("past"), "BTC", day * 2 + 5, day * 4 + 5, ordered=True)
    assert [r["price"] for r in bounded.collect()] == [3.0, 5.0]
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "trade_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in plan
    assert history.load_trades(spark, folder("past"), "BTC").count() == 5


def test_table_is_created_once(spark, folder, trades_of):
    name = "history_test"
    for _ in range(2):
        history.create_table(spark, name, folder("table"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    history.append_table(trades_of([(5, 1.0, 2.0)]), name)
    assert spark.table(name).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_append_log_and_text_frames(spark, folder, landed):
    source = raw.stream_frames(spark, landed, max_files_per_trigger=1)
    run(ingest.append_log(normalize.normalize(source)[0], folder("log"), folder("cp")))
    assert spark.read.parquet(folder("log")).count() == normalize.normalize(raw.read_frames(spark, landed))[0].count()
    raw.read_frames(spark, landed).orderBy("seq").coalesce(1).select("value").write.text(folder("text"))
    lines = raw.read_text(spark, folder("text"))
    assert lines.count() == 300 and lines.select("seq").distinct().count() == 300


def test_text_positions_follow_files_and_lines(spark, tmp_path):
    (tmp_path / "part-0").write_text("a0\na1\na2\n")
    (tmp_path / "part-1").write_text("".join(f"b{i}\n" for i in range(3000)))
    got = [r["value"] for r in raw.read_text(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == ["a0", "a1", "a2", *(f"b{i}" for i in range(3000))]


def test_two_feeds_share_their_sinks(spark, folder):
    """Both begin with batch 0, as does a feed whose checkpoint was reset."""
    total = 0
    for name, begin, end in (("a", 0, 40), ("b", 40, 100), ("a-reset", 100, 130)):
        frames(spark, begin, end).write.parquet(folder(f"raw-{name}"))
        source = raw.stream_frames(spark, folder(f"raw-{name}"))
        run(ingest.start(source, folder("log"), folder("past"), folder(f"cp-{name}"), rejects_path=folder("bad"), symbol="X"))
        total += end - begin
        n = history.load_trades(spark, folder("past"), "X").count()
        assert n == spark.read.option("recursiveFileLookup", "true").parquet(folder("log")).count()
        assert n + spark.read.option("recursiveFileLookup", "true").parquet(folder("bad")).count() == total


def test_bad_frames_end_an_ingest_unless_told_otherwise(spark, folder, landed):
    batch = raw.read_frames(spark, landed)
    with pytest.raises(ValueError, match="bad trade message"):
        ingest.fan_out(batch, 0, folder("log"), folder("past"))
    assert not paths.exists(spark, folder("log")) and not paths.exists(spark, folder("past"))
    ingest.fan_out(batch, 0, folder("log"), folder("past"), drop_rejects=True)
    assert history.load_trades(spark, folder("past")).count() == normalize.normalize(batch)[0].count()


def test_a_batch_is_seen_whole_or_not_at_all(spark, folder, landed, monkeypatch):
    """The driver is lost after writing, before publishing."""
    batch = raw.read_frames(spark, landed)
    at = paths._at

    class Lost:
        def __init__(self, files):
            self.files = files

        def rename(self, source, goal):
            raise ConnectionError("driver lost")

        def __getattr__(self, name):
            return getattr(self.files, name)

    monkeypatch.setattr(paths, "_at", lambda spark, path: (Lost(at(spark, path)[0]), at(spark, path)[1]))
    with pytest.raises(ConnectionError):
        paths.write_once(batch, folder("log"), "f", 0)
    monkeypatch.setattr(paths, "_at", at)
    seen = spark.read.schema(raw.RAW_FRAME).option("recursiveFileLookup", "true").parquet(folder("log"))
    assert seen.count() == 0
    for _ in range(2):
        paths.write_once(batch, folder("log"), "f", 0)
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder("log")).count() == 300


def test_feeds_are_named_by_their_checkpoint(spark, folder):
    one = paths.feed_id(spark, folder("cp"))
    assert paths.feed_id(spark, folder("cp")) == one
    paths.remove(spark, folder("cp"))
    assert paths.feed_id(spark, folder("cp")) != one


def test_replay_is_in_order_and_pruned(spark, folder, trades_of):
    day = 86_400_000
    rows = [(day * (i % 4) + 4 * i, 1.0, 1.0, "buy", f"S{i % 3}") for i in range(60)]
    history.append(trades_of(rows), folder("past"))
    replay.publish(history.open_history(spark, folder("past")), 0, 9 * day, folder("again"))
    found = spark.read.parquet(folder("again"))
    want = sorted((r[0], i) for i, r in enumerate(rows))
    assert [(int(r["ts"]), r["seq"]) for r in found.orderBy("position").collect()] == want
    assert [r["position"] for r in found.orderBy("position").collect()] == list(range(1, 61))
    # Files follow each other in the order of their names.
    in_files = found.select("*", F.input_file_name().alias("file")).groupBy("file").agg(F.min("position").alias("a"), F.max("position").alias("b"))
    spans = [(r["a"], r["b"]) for r in in_files.orderBy("file").collect()]
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    minute = history.replay_range(history.open_history(spark, folder("past")), day, day + 60_000)
    assert {r["symbol"] for r in minute.select("symbol").collect()} <= {"S0", "S1", "S2"}
    plan = minute._jdf.queryExecution().executedPlan().toString()
    assert "trade_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_new_only_streams_pass_over_old_files(spark, folder, landed):
    def tailed(since):
        seen = []
        source = raw.stream_frames(spark, landed, since_ms=since)
        run(tail.tail(source, folder(f"cp-{since}"), lambda batch, _: seen.append(batch.count())))
        return sum(seen)

    assert tailed(0) == 300
    assert tailed(int(time.time() * 1000) + 60_000) == 0
    first = paths.remembered(spark, folder("cp"), "since", "5")
    assert first == paths.remembered(spark, folder("cp"), "since", "9") == "5"


def test_tail_job(spark, folder, landed, capfd):
    run_stream.main(["ingest", landed, folder("log"), folder("past"), "--checkpoint", folder("c1"), "--rejects", folder("bad")], spark)
    run_stream.main(["tail", folder("log"), "--checkpoint", folder("c2"), "--max-files", "1"], spark)
    with pytest.raises(SystemExit):
        run_stream.main(["tail", folder("log")], spark)


def test_scopes_remove_what_was_made_inside(spark, trades_of):
    from tapeloom import session

    with session.scope(spark):
        kept = session.materialize(trades_of([(5, 1.0, 2.0)]), "scoped")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert paths.exists(spark, path)
    assert not paths.exists(spark, path)


def test_kafka_records(trades_of):
    row = raw.kafka_records(trades_of([(5, None, 2.0)])).first()
    assert row["key"] == "BTCUSDT"
    assert json.loads(row["value"]) == {"symbol": "BTCUSDT", "seq": 0, "ts": 5, "price": None, "qty": 2.0, "side": "buy"}


def test_kafka_frames_have_a_position_each(spark):
    records = [(p, o, bytearray(f"{p}-{o}".encode()) if o != 2 else None) for p in (0, 1, 16000) for o in (0, 1, 2, 1 << 45)]
    frames = raw.kafka_frames(spark.createDataFrame(records, "partition int, offset bigint, value binary"))
    rows = frames.collect()
    assert frames.columns == ["seq", "value"] and len({r.seq for r in rows}) == len(records) and min(r.seq for r in rows) >= 0
    for p in (0, 1, 16000):
        own = [r.seq for r, x in zip(rows, records) if x[0] == p]
        assert own == sorted(own)
    assert [r.value for r in rows][:3] == ["0-0", "0-1", None]


def test_ingest_job_reads_a_topic(spark, folder, monkeypatch):
    """The records of a topic, stood in for by files with the connector's columns."""
    records = [(p, o, json.dumps({"T": 1700000000000 + o, "p": "5.0", "q": str(p + 1), "m": False})) for p in (0, 1) for o in range(3)]
    given = "partition int, offset bigint, value string"
    spark.createDataFrame(records, given).selectExpr("partition", "offset", "CAST(value AS binary) AS value").write.parquet(folder("topic"))
    asked = []

    def stream(session, servers, topic, **options):
        asked.append((servers, topic, options))
        return raw.kafka_frames(session.readStream.schema("partition int, offset bigint, value binary").parquet(topic))

    monkeypatch.setattr(raw, "stream_kafka", stream)
    run_stream.main(
        ["ingest", folder("topic"), folder("log"), folder("past"), "--kafka", "host:1", "--checkpoint", folder("cp"),
         "--rejects", folder("bad"), "--symbol", "S", "--new-only", "--max-offsets", "7"], spark,
    )
    assert asked == [("host:1", folder("topic"), {"starting": "latest", "max_offsets_per_trigger": 7})]
    kept = history.load_trades(spark, folder("past"), "S").collect()
    assert sorted((r.seq, r.qty) for r in kept) == sorted(((o << raw.PARTITION_BITS) | p, p + 1.0) for p, o, _ in records)


def test_failed_attempts_are_removed(spark, folder):
    base = Path(folder("log"))
    for name in ("f-3-old", "f-30-other", "g-3-other"):
        (base / paths.UNFINISHED / name).mkdir(parents=True)
    paths.write_once(spark.range(3).toDF("n"), str(base), "f", 3)
    assert sorted(p.name for p in (base / paths.UNFINISHED).iterdir() if not p.name.startswith(".")) == ["f-30-other", "g-3-other"]
    assert spark.read.parquet(str(base / "feed=f" / "batch=3")).count() == 3
