"""Queries over the given tables, each with the SQL that must give the same rows.

Trades come from `events` (a tick stream, distinct times, quiet minutes) and
from `lineitem` (many trades per time). Computed doubles are rounded to six
places on both sides, because sums of doubles depend on their order.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tapeloom import session  # noqa: E402
from tapeloom.functions.timebucket import floor_to  # noqa: E402
from tapeloom.operators import asof, backtest, bars, correlation, divergence, labels, metrics, normalize, ordered  # noqa: E402
from tapeloom.operators import orderflow, quantiles, recent, scoring, training  # noqa: E402
from tapeloom.plans import build_features, rebuild_features  # noqa: E402
from tapeloom.sources import features, history, models, paths, raw  # noqa: E402
from tapeloom.streaming import accuracy as accuracy_stream  # noqa: E402
from tapeloom.streaming import ingest as ingest_stream  # noqa: E402
from tapeloom.streaming import monitor  # noqa: E402
from tapeloom.streaming import orderflow as orderflow_stream  # noqa: E402
from tapeloom.streaming import replay as replay_stream  # noqa: E402
from tapeloom.streaming import scoring as scoring_stream  # noqa: E402
from tapeloom.streaming import tail  # noqa: E402
from tapeloom.streaming import volatility as volatility_stream  # noqa: E402

try:  # the only place that may do without the training-data subpackage
    import corpus_pipeline
    from tapeloom.llm import queries as llm_queries
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "tapeloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

MINUTE = 60_000
NUDGE = 1e-9
# Below this, a double has places enough behind the sixth to tell what a half is.
PLAIN = 65536.0
RANGE_START = 1704412800000  # 2024-01-05 00:00 UTC
RANGE_END = 1705708799999  # 2024-01-19 23:59:59.999 UTC


# --- trades from the given tables -------------------------------------------


def _as_trades(events: DataFrame, with_symbol: bool) -> DataFrame:
    columns = {
        "seq": F.col("event_id"),
        "ts": F.unix_millis(F.col("ts").cast("timestamp")),
        "price": F.col("value"),
        "qty": F.get_json_object("props", "$.k").cast("double"),
        "side": F.when(F.col("event_type").isin("purchase", "click"), "buy")
        .when(F.col("event_type").isin("view", "error"), "sell")
        .otherwise("other"),
    }
    if with_symbol:
        columns["symbol"] = F.concat(F.lit("SYM"), F.pmod("user_id", F.lit(5)).cast("string"))
    return events.select(*[c.alias(n) for n, c in columns.items()])


def trades(spark: SparkSession, sf_dir: str, with_symbol: bool = True) -> DataFrame:
    session.prepare(spark)
    return _as_trades(spark.read.parquet(f"{sf_dir}/events.parquet"), with_symbol)


def trades_stream(spark: SparkSession, sf_dir: str, **caps: int) -> DataFrame:
    session.prepare(spark)
    path = f"{sf_dir}/events.parquet"
    return _as_trades(raw.stream_frames(spark, f"{path}*", spark.read.parquet(path).schema, **caps), True)


def line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades: whole days as times, so almost every time has ties."""
    session.prepare(spark)
    order = F.shiftleft(F.col("l_orderkey"), 30).bitwiseOR(
        F.shiftleft(F.col("l_linenumber").cast("bigint"), 27)
    )
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        order.bitwiseOR(F.col("l_partkey")).alias("seq"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
        F.when(F.col("l_returnflag") == "R", "buy").when(F.col("l_returnflag") == "A", "sell").otherwise("other").alias("side"),
        F.col("l_suppkey").cast("string").alias("symbol"),
    )


def raw_frames(ticks: DataFrame) -> DataFrame:
    """Exchange messages of the trades, some of them broken in known ways."""
    message = F.to_json(
        F.struct(
            F.col("ts").alias("T"),
            F.when((F.col("side") == "sell") & (F.col("qty") < 5), "abc").otherwise(F.col("price").cast("string")).alias("p"),
            F.col("qty").cast("string").alias("q"),
            # Left out by to_json where it is NULL.
            F.when((F.col("side") != "other") | (F.col("qty") >= 10), F.col("side") != "buy").alias("m"),
        )
    )
    cut = (F.col("side") == "buy") & (F.col("qty") < 5)
    return ticks.select("seq", F.when(cut, F.substring(message, 1, 9)).otherwise(message).alias("value"))


def dialect_frames(ticks: DataFrame) -> DataFrame:
    """Buys with short keys, the rest with long ones; some long prices absent, some quantities tiny."""
    short = F.to_json(F.struct(
        F.col("ts").alias("T"), F.col("price").cast("string").alias("p"), F.col("qty").cast("string").alias("q"), F.lit(False).alias("m"),
    ))
    tiny = F.when(F.col("side") == "other", F.col("qty") / 100000).otherwise(F.col("qty"))
    long = F.to_json(F.struct("ts", F.when(F.col("qty") >= 5, F.col("price")).alias("price"), tiny.alias("qty"), "side"))
    return ticks.select("seq", F.when(F.col("side") == "buy", short).otherwise(long).alias("value"))


def log_fields(ticks: DataFrame) -> DataFrame:
    """Log entries as string maps; which fields are there, and how times are spelled, depends on the side."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("k"), c.cast("string").alias("v")) for n, c in {
            "ts": F.when(F.col("side") == "sell", F.regexp_replace(F.col("ts").cast("string"), "(...)$", "_$1 ")).otherwise(F.col("ts").cast("string")),
            "price": F.col("price"),
            "qty": F.when(F.col("side") != "sell", F.col("qty")),
            "side": F.when(F.col("side") != "other", F.col("side")),
            "ofi": F.when(F.col("side") == "other", F.col("price") / 8),
        }.items()]
    )
    return ticks.select("seq", F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull())).alias("fields"))


# --- shared pieces ------------------------------------------------------------


def r6(name: str):
    """Six places; the nudge keeps exact halves, which engines round apart, off the edge.

    `round` goes through decimals, which costs more than all else of a bar; below
    `PLAIN` the same number comes from plain doubles, the quotient of two whole ones.
    """
    nudged = F.col(name) + NUDGE
    plain = F.rint(nudged * 1e6) / F.lit(1e6)
    return (F.when(F.abs(nudged) < PLAIN, plain).otherwise(F.round(nudged, 6)) + F.lit(0.0)).alias(name)


def bar_view(df: DataFrame, *columns: str) -> DataFrame:
    """Bars with the bucket as epoch ms and doubles rounded."""
    doubles = {n for n, t in df.dtypes if t == "double"}
    keep = columns or tuple(c for c in df.columns if c not in ("timestamp", "symbol"))
    return df.select(
        "symbol", F.unix_millis("timestamp").alias("bucket"), *[r6(c) if c in doubles else F.col(c) for c in keep]
    )


OHLCV = ("price_open", "price_high", "price_low", "price_close", "volume", "trade_count")


def sparse_view(df: DataFrame) -> DataFrame:
    return df.select("symbol", "bucket", *[r6(c) if c != "trade_count" else F.col(c) for c in OHLCV])


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled bars of all symbols."""
    return labels.labelled_bars(trades(spark, sf_dir))


def scored_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule scores of the trades with the label of the bar each one fell into."""
    marked = labelled(spark, sf_dir).select("symbol", F.unix_millis("timestamp").alias("bucket"), "label")
    ticks = trades(spark, sf_dir).withColumn("bucket", floor_to(F.col("ts"), MINUTE))
    return scoring.heuristic(ticks.withColumn("ofi", F.lit(0.0))).join(marked, ["symbol", "bucket"])


def _drain(query) -> None:
    query.awaitTermination()


# --- queries ------------------------------------------------------------------


def q_raw_parse(spark, sf_dir):
    return normalize.normalize(raw_frames(trades(spark, sf_dir)))[1].select("seq", "reason")


def q_normalize_trade(spark, sf_dir):
    return normalize.normalize(raw_frames(trades(spark, sf_dir)))[0].select("seq", "ts", "price", "qty", "side")


def q_normalize_dialects(spark, sf_dir):
    return normalize.normalize_dialects(dialect_frames(trades(spark, sf_dir))).select("seq", "id", "ts", "price", "qty", "side")


def q_coerce_fields(spark, sf_dir):
    typed = normalize.coerce_fields(log_fields(trades(spark, sf_dir)))
    return typed.select("seq", "ts", "price", "qty", "side", r6("ofi"))


def q_load_trades(spark, sf_dir):
    return history.select_trades(trades(spark, sf_dir), "SYM1", RANGE_START, RANGE_END)


def q_history_load(spark, sf_dir):
    path = session.shared_folder(spark, "history")
    history.append(trades(spark, sf_dir), path)
    return history.load_trades(spark, path, "SYM3", RANGE_START, RANGE_END)


def q_replay_range(spark, sf_dir):
    return history.replay_range(trades(spark, sf_dir, with_symbol=False), RANGE_START, RANGE_END)


def q_replay_strings(spark, sf_dir):
    return history.replay_entries(trades(spark, sf_dir))


def q_replay_roundtrip(spark, sf_dir):
    out = session.shared_folder(spark, "replay")
    replay_stream.publish(trades(spark, sf_dir), RANGE_START, RANGE_END, out)
    return orderflow.imbalance(replay_stream.received(spark.read.parquet(out)))


def q_replay_stream(spark, sf_dir):
    """A range of the history published in order and tailed by a stream."""
    past, out, log, checkpoint = (session.shared_folder(spark, n) for n in ("history", "replay", "log", "replay-cp"))
    history.append(trades(spark, sf_dir), past)
    replay_stream.publish(history.open_history(spark, past), RANGE_START, RANGE_END, out)
    entries = raw.stream_frames(spark, out, spark.read.parquet(out).schema)
    _drain(ingest_stream.append_log(entries, log, checkpoint))
    return spark.read.parquet(log)


def q_bars_ohlcv(spark, sf_dir):
    return sparse_view(bars.sparse_bars(trades(spark, sf_dir, with_symbol=False)))


def q_bars_7min(spark, sf_dir):
    return sparse_view(bars.sparse_bars(trades(spark, sf_dir), "7min"))


def q_bars_ties(spark, sf_dir):
    return sparse_view(bars.sparse_bars(line_trades(spark, sf_dir), "7D"))


def q_bars_weekly(spark, sf_dir):
    return sparse_view(bars.sparse_bars(line_trades(spark, sf_dir), "W"))


def q_bars_monthly(spark, sf_dir):
    return sparse_view(bars.sparse_bars(line_trades(spark, sf_dir), "ME"))


def q_bars_dense(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir)), *OHLCV)


def q_bars_vwap(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir)), "vwap")


def q_bars_returns(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir)), "return_1")


def q_bars_rolling(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir)), *bars.feature_columns(bars.DEFAULT_WINDOWS))


def q_bars_full(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir)))


def q_features_saved(spark, sf_dir):
    path = features.save_features(bars.compute(trades(spark, sf_dir)), session.shared_folder(spark, "features"))
    return bar_view(features.load_features(spark, path))


def q_bars_full_7min(spark, sf_dir):
    return bar_view(bars.compute(trades(spark, sf_dir), "7min", (2, 30)))


def q_bars_daily(spark, sf_dir):
    return bar_view(bars.compute(line_trades(spark, sf_dir), "1D"))


def q_ofi(spark, sf_dir):
    return orderflow.imbalance(trades(spark, sf_dir))


def q_ofi_prefix(spark, sf_dir):
    return orderflow.imbalance(trades(spark, sf_dir), chunk_bits=10)


def q_ofi_chunks(spark, sf_dir):
    return orderflow.imbalance_by_chunks(trades(spark, sf_dir))


def q_ofi_no_seq(spark, sf_dir):
    return orderflow.imbalance(trades(spark, sf_dir).drop("seq"))


def q_ofi_single(spark, sf_dir):
    return orderflow.imbalance(trades(spark, sf_dir, with_symbol=False))


def q_ofi_stream(spark, sf_dir):
    out, checkpoint = session.shared_folder(spark, "ofi"), session.shared_folder(spark, "ofi-cp")
    _drain(orderflow_stream.start(trades_stream(spark, sf_dir), out, checkpoint))
    return spark.read.parquet(out).select("symbol", "seq", "ts", "ofi")


def q_ofi_stateful(spark, sf_dir):
    out, checkpoint = session.shared_folder(spark, "ofi"), session.shared_folder(spark, "ofi-cp")
    capped = trades_stream(spark, sf_dir, max_bytes_per_trigger=orderflow_stream.STATEFUL_BYTES)
    _drain(orderflow_stream.start_stateful(capped, out, checkpoint))
    return spark.read.parquet(out)


def q_ingest_stream(spark, sf_dir):
    log, past, bad, checkpoint = (session.shared_folder(spark, n) for n in ("log", "history", "rejects", "ingest-cp"))
    frames = raw_frames(trades_stream(spark, sf_dir))
    _drain(ingest_stream.start(frames, log, past, checkpoint, rejects_path=bad, symbol="BTCUSDT"))
    return history.load_trades(spark, past, "BTCUSDT")


def q_ingest_two_feeds(spark, sf_dir):
    """Two feeds with a checkpoint each into one log, history and folder of rejects."""
    log, past, bad = (session.shared_folder(spark, n) for n in ("log", "history", "rejects"))
    for part in (0, 1):
        frames = raw_frames(trades_stream(spark, sf_dir)).where(F.col("seq") % 2 == part)
        checkpoint = session.shared_folder(spark, "ingest-cp")
        _drain(ingest_stream.start(frames, log, past, checkpoint, rejects_path=bad, symbol="BTCUSDT"))
    columns = ("seq", "ts", "price", "qty", "side")
    logged = spark.read.schema(raw.TRADE).option("recursiveFileLookup", "true").parquet(log).select(*columns)
    loaded = history.load_trades(spark, past, "BTCUSDT").select(*columns)
    rejected = spark.read.option("recursiveFileLookup", "true").parquet(bad).select("seq", F.col("reason").alias("side"))
    parts = {"log": logged, "history": loaded, "rejects": rejected}
    first, *rest = [df.withColumn("sink", F.lit(name)) for name, df in parts.items()]
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def q_log_tail(spark, sf_dir):
    """The live log read to its end by a second consumer."""
    log, past, seen = (session.shared_folder(spark, n) for n in ("log", "history", "seen"))
    frames = raw_frames(trades_stream(spark, sf_dir))
    _drain(ingest_stream.start(frames, log, past, session.shared_folder(spark, "cp"), drop_rejects=True, symbol="BTCUSDT"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")

    _drain(tail.tail(raw.stream_trades(spark, log), session.shared_folder(spark, "cp"), keep))
    return spark.read.parquet(seen).drop("batch")


def q_text_frames(spark, sf_dir):
    """Messages landed as text files; their positions are the order of arrival."""
    path = session.shared_folder(spark, "text")
    raw_frames(trades(spark, sf_dir)).repartitionByRange(5, "seq").sortWithinPartitions("seq").select("value").write.text(path)
    lines = ordered.running(raw.read_text(spark, path), [], "seq", {"position": F.lit(1).cast("bigint")})
    return normalize.normalize(lines)[0].select("position", "ts", "price", "qty", "side")


def q_heuristic_score(spark, sf_dir):
    scored = scoring.payload(normalize.coerce_fields(log_fields(trades(spark, sf_dir))).withColumnRenamed("seq", "id"))
    return scored.select("id", "ts", "price", "qty", "side", *map(r6, ("ofi", "prob_up", "prob_down")), "predictor")


def _read_payload(texts: DataFrame) -> DataFrame:
    schema = "id string, ts bigint, price double, qty double, side string, ofi double, prob_up double, prob_down double, predictor string"
    opened = texts.select(F.from_json("value", schema).alias("p")).select("p.*")
    return opened.select("id", "ts", "price", "qty", "side", *map(r6, ("ofi", "prob_up", "prob_down")), "predictor")


def q_score_json(spark, sf_dir):
    entries = scoring_stream.entries_of(trades(spark, sf_dir))
    return _read_payload(scoring.payload_json(scoring.payload(entries)))


def q_score_stream(spark, sf_dir):
    out, checkpoint = session.shared_folder(spark, "scored"), session.shared_folder(spark, "scored-cp")
    _drain(scoring_stream.start(scoring_stream.entries_of(trades_stream(spark, sf_dir)), out, checkpoint))
    return _read_payload(spark.read.text(out))


def q_labels(spark, sf_dir):
    return bar_view(labelled(spark, sf_dir), "price_close", "future_return", "label")


def q_labels_h3(spark, sf_dir):
    return bar_view(labels.labelled_bars(trades(spark, sf_dir), "7min", (3,), 3, 0.0), "future_return", "label")


def q_labels_wide(spark, sf_dir):
    """A horizon that is wider than a chunk would otherwise be."""
    return bar_view(labels.labelled_bars(trades(spark, sf_dir), "1min", (3,), 5000), "future_return", "label")


def q_labels_of_bars(spark, sf_dir):
    """Targets of bars that are made already."""
    path = features.save_features(bars.compute(trades(spark, sf_dir)), session.shared_folder(spark, "features"))
    return bar_view(labels.build_targets(features.load_features(spark, path)), "price_close", "future_return", "label")


def q_chrono_split(spark, sf_dir):
    written = session.materialize(labelled(spark, sf_dir), "labelled")
    return bar_view(labels.chrono_split(written), "label", "is_test")


def q_auc_rank(spark, sf_dir):
    return metrics.roc_auc(scored_ticks(spark, sf_dir)).select(r6("roc_auc"))


def q_class_metrics(spark, sf_dir):
    return metrics.class_metrics(scored_ticks(spark, sf_dir)).select(*map(r6, ("accuracy", "precision", "recall", "f1")))


def q_train_model(spark, sf_dir):
    """How far the fitted coefficients are from a minimum of the penalised loss: its gradient, by term.

    The fit sees the earlier 80 % of each symbol's labelled bars whose returns are finite.
    """
    written = session.materialize(labelled(spark, sf_dir), "labelled")
    terms = ("return_1", "vol_3", "ma_3")
    bundle, _ = training.train(written, terms, unusable="drop")
    rows = training.usable(labels.chrono_split(written).where(~F.col("is_test")), terms).persist()
    off = scoring.score(rows, bundle).withColumn("off", F.col("prob_up") - F.col("label"))
    fitted = bundle.model.stages[-1]
    sums = off.agg(F.count(F.lit(1)).alias("rows"), F.sum("off").alias("intercept"), *[F.sum(F.col("off") * F.col(t)).alias(t) for t in terms])
    gradient = [F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("g"))]
    gradient += [F.struct(F.lit(t).alias("term"), (F.col(t) + F.lit(float(c))).alias("g")) for t, c in zip(terms, fitted.coefficients)]
    each = sums.select("rows", F.explode(F.array(*gradient)).alias("x"))
    return each.select("x.term", "rows", (F.round(F.col("x.g") / F.col("rows"), 4) + F.lit(0.0)).alias("gradient"))


def q_model_score(spark, sf_dir):
    """Bars scored by a saved and reloaded model, and by the same model where the bars miss its column.

    With one 0/1 feature and no penalty to speak of, the fitted probabilities are
    the shares of ones among the training rows with and without the feature.
    """
    up = F.when(F.col("price_close") >= F.col("price_open"), 1).otherwise(0)
    written = session.materialize(labelled(spark, sf_dir).withColumn("up", up), "labelled")
    bundle, quality = training.train(written, ("up",), C=1e9)
    path = models.save_model(spark, bundle, session.shared_folder(spark, "model"), {"metrics": quality})
    models.save_model(spark, bundle, path, {"metrics": quality})
    loaded = models.load_model(spark, path)
    scored = scoring.score(written, loaded).withColumnsRenamed({"prob_up": "p_up", "prob_down": "p_down"}).drop("predictor", "up")
    both = scoring.score(scored, loaded)
    names = {"p_up": "p_up", "p_down": "p_down", "prob_up": "missing_up"}
    rounded = [(F.round(F.col(c) + NUDGE, 4) + F.lit(0.0)).alias(n) for c, n in names.items()]
    return both.select("symbol", F.unix_millis("timestamp").alias("bucket"), "label", *rounded, "predictor")


def q_last_n(spark, sf_dir):
    return recent.last_trades(trades(spark, sf_dir)).select("symbol", "seq", "ts", "price", "qty", "side")


def q_latest_trade(spark, sf_dir):
    return recent.latest_trade(trades(spark, sf_dir)).select("symbol", "seq", "ts", "price", "qty", "side")


def q_change_pct(spark, sf_dir):
    return recent.summary(trades(spark, sf_dir)).select("symbol", "last_price", r6("change_pct"))


def q_ticker(spark, sf_dir):
    return recent.ticker(recent.summary(trades(spark, sf_dir)))


def q_trade_feed(spark, sf_dir):
    return recent.trade_feed(trades(spark, sf_dir))


def q_monotone_axis(spark, sf_dir):
    return recent.monotone_axis(trades(spark, sf_dir))


def q_axis_no_seq(spark, sf_dir):
    return recent.monotone_axis(trades(spark, sf_dir).drop("seq"))


def q_monotone_axis_ties(spark, sf_dir):
    return recent.monotone_axis(line_trades(spark, sf_dir)).select("symbol", "seq", "ts", "axis")


def q_chart_points(spark, sf_dir):
    return recent.chart_points(trades(spark, sf_dir))


def _positions(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_mktsegment").alias("symbol"), F.lit(1.0).alias("quantity"), F.col("c_acctbal").alias("value")
    )


def q_portfolio_total(spark, sf_dir):
    return recent.portfolio_total(_positions(spark, sf_dir)).select(r6("total_value"))


def q_portfolio_lines(spark, sf_dir):
    held = _positions(spark, sf_dir).groupBy("symbol").agg(F.sum("quantity").alias("quantity"), F.sum("value").alias("value"))
    return recent.portfolio_lines(held).select("symbol", "quantity", r6("value"), "value_text")


ASOF_FEATURES = ("closed_at", "price_close", "return_1", "ma_3", "vol_5")


def q_asof_features(spark, sf_dir):
    """Trades with the features of the newest bar that had closed."""
    seen = asof.closed_features(trades(spark, sf_dir), bars.compute(trades(spark, sf_dir)), "1min")
    return seen.select("symbol", "seq", "ts", "closed_at", *map(r6, ASOF_FEATURES[1:]))


def q_asof_ties(spark, sf_dir):
    """Line items with the newest order of their customer's priority class, many of both on a day."""
    session.prepare(spark)
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"), millis("l_shipdate").alias("ts"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.when(F.col("o_orderpriority") < "3", "A").when(F.col("o_orderpriority") < "5", "N").otherwise("R").alias("flag"), millis("o_orderdate").alias("ordered"), "o_orderkey"
    )
    found = asof.join(lines, orders.groupBy("flag", "ordered").agg(F.max("o_orderkey").alias("newest")), ["flag"], "ts", "ordered", most_rows=4096)
    return found.select("l_orderkey", "l_linenumber", "flag", "ts", "ordered", "newest")


def q_asof_model_score(spark, sf_dir):
    """Trades scored by a model of bar features, through the bar each of them could see.

    With one 0/1 feature and no penalty to speak of, the probabilities are shares
    among the training rows; trades before the first closed bar lack the feature, which
    then counts as 0.
    """
    up = F.when(F.col("price_close") >= F.col("price_open"), 1).otherwise(0)
    written = session.materialize(labelled(spark, sf_dir).withColumn("up", up), "labelled")
    bundle, _ = training.train(written, ("up",), C=1e9)
    made = session.materialize(bars.compute(trades(spark, sf_dir)).withColumn("up", up).select("symbol", "timestamp", "up"), "features")
    seen = asof.closed_features(trades(spark, sf_dir), made, "1min")
    return scoring.score(seen, bundle).select("symbol", "seq", (F.round(F.col("prob_up") + NUDGE, 4) + F.lit(0.0)).alias("prob_up"), "predictor")


def _live_and_replayed(spark, sf_dir):
    """Order flow as computed live, and from a replay that lost and doubled trades and changed sides."""
    live = orderflow.imbalance(trades(spark, sf_dir))
    heard = trades(spark, sf_dir).where(F.col("seq") % 997 != 5)
    heard = heard.withColumn("side", F.when(F.col("seq") % 499 == 7, "sell").otherwise(F.col("side")))
    again = orderflow.imbalance(heard)
    return live, again.unionByName(again.where(F.col("seq") % 811 == 3))


def q_replay_differences(spark, sf_dir):
    """Every row of live features without an equal one in the replay, and the other way round."""
    found = divergence.differences(*_live_and_replayed(spark, sf_dir), ["symbol", "seq"])
    return found.select("symbol", "seq", "copy", "status", F.array_join("differing", ",").alias("differing"), F.col("left.ofi").alias("live"), F.col("right.ofi").alias("replayed"))


def q_replay_divergence(spark, sf_dir):
    """How much of the features diverges, by kind and by column."""
    return divergence.report(*_live_and_replayed(spark, sf_dir), ["symbol", "seq"])


def q_stream_accuracy(spark, sf_dir):
    """Forecasts of a stream of scored trades against labels that a second stream brings later."""
    known, out, checkpoint = (session.shared_folder(spark, n) for n in ("known-labels", "accuracy", "accuracy-cp"))
    told = labelled(spark, sf_dir).select("symbol", F.unix_millis("timestamp").alias("bucket"), F.col("label").cast("int").alias("label"))
    told.write.parquet(known)
    scored = scoring.heuristic(trades_stream(spark, sf_dir).withColumn("ofi", F.lit(0.0)))
    later = raw.stream_frames(spark, known, told.schema)
    _drain(accuracy_stream.start(scored, later, out, checkpoint, rule="1min", window_ms=86_400_000))
    return accuracy_stream.read(spark, out).select("symbol", "window", "n", "hits", r6("accuracy"))


def q_stream_volatility(spark, sf_dir):
    """Rolling volatility of the bars that a stream of trades has closed."""
    out, checkpoint = (session.shared_folder(spark, n) for n in ("volatility", "volatility-cp"))
    _drain(volatility_stream.start(trades_stream(spark, sf_dir), out, checkpoint, rule="1min", delay="30 minutes"))
    return spark.read.parquet(out).select("symbol", "bucket", *map(r6, ("price_close", "return_1", "vol_3", "vol_5", "vol_15")))


def _delays(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items as events: the day of their order, and how many days later they were shipped, some before it."""
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(millis("o_orderdate").alias("ts"), ((millis("l_shipdate") - millis("o_orderdate")) / 86_400_000 + F.col("l_linenumber") / 8).alias("latency"))


MONTH = 30 * 86_400_000


def q_latency_exact(spark, sf_dir):
    session.prepare(spark)
    delays = _delays(*(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "orders"))).withColumn("window", floor_to(F.col("ts"), MONTH))
    return quantiles.exact(delays, ["window"], "latency").select("window", "probability", r6("value"))


def q_stream_latency(spark, sf_dir):
    """Quantiles of a stream's delays from sketches that its micro-batches have left."""
    session.prepare(spark)
    out, checkpoint = (session.shared_folder(spark, n) for n in ("latency", "latency-cp"))
    path = f"{sf_dir}/lineitem.parquet"
    lines = raw.stream_frames(spark, f"{path}*", spark.read.parquet(path).schema)
    _drain(monitor.start_latency(_delays(lines, spark.read.parquet(f"{sf_dir}/orders.parquet")), F.col("latency"), out, checkpoint, window_ms=MONTH))
    return monitor.read_latency(spark, out).select("window", "probability", r6("value"))


def q_stream_throughput(spark, sf_dir):
    out, checkpoint = (session.shared_folder(spark, n) for n in ("throughput", "throughput-cp"))
    _drain(monitor.start_throughput(trades_stream(spark, sf_dir), out, checkpoint, unit_ms=MINUTE))
    return monitor.read_throughput(spark, out, MINUTE)


def _curve(spark, sf_dir):
    """A hundredth of the equity follows the last change of the price for one bar."""
    held = F.when(F.col("return_1") > 0, 1.0).when(F.col("return_1") < 0, -0.5).otherwise(0.0)
    return backtest.equity(backtest.strategy_returns(labelled(spark, sf_dir), held, cost=0.001, stake=0.01))


def q_backtest_curve(spark, sf_dir):
    log = _curve(spark, sf_dir).withColumn("log_equity", F.ln("equity"))
    return bar_view(log, "position", "log_equity", "drawdown")


def q_backtest_summary(spark, sf_dir):
    found = backtest.summary(_curve(spark, sf_dir)).withColumn("log_equity", F.ln("final_equity"))
    return found.select("symbol", "bars", "trades", "wins", r6("log_equity"), r6("worst_drawdown"))


def q_correlations(spark, sf_dir):
    found = correlation.correlations(bars.compute(trades(spark, sf_dir)), 86_400_000, block=2)
    return found.select("window", "symbol", "other", "n", r6("correlation"))


def q_features_rebuilt(spark, sf_dir):
    """A store of bars after its history grew by later days and by late trades of one day."""
    past, store = (session.shared_folder(spark, n) for n in ("history", "store"))
    ticks = trades(spark, sf_dir)
    late = (F.col("ts") >= RANGE_START) & (F.col("ts") < RANGE_START + 86_400_000) & (F.col("seq") % 2 == 0)
    early = F.col("ts") <= RANGE_END
    for part in (early & ~late, ~early | late):
        history.append(ticks.where(part), past)
        rebuild_features.rebuild(spark, past, store)
    return bar_view(rebuild_features.load_store(spark, store).drop("bar_date"))


def q_features_job(spark, sf_dir):
    """The job on a history of one unnamed symbol; the features are found by their name."""
    past, out = (session.shared_folder(spark, n) for n in ("history", "features"))
    history.append(trades(spark, sf_dir, with_symbol=False), past)
    build_features.main(["UNKNOWN", "--db", past, "--outdir", out], spark)
    return bar_view(features.load_features(spark, paths.features_path(out, "UNKNOWN", bars.DEFAULT_RULE)))


def q_history_table(spark, sf_dir):
    """Trades added twice to a catalogued table, which is made once."""
    path, name = session.shared_folder(spark, "history"), f"trades_{uuid.uuid4().hex}"
    ticks = trades(spark, sf_dir)
    for part in (0, 1):
        history.create_table(spark, name, path)
        history.append_table(ticks.where(F.pmod("seq", F.lit(2)) == part), name)
    days = spark.table(name).groupBy("symbol", "trade_date").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"), F.max("seq").alias("newest"))
    return days.select("symbol", F.unix_date("trade_date").alias("day"), "n", r6("qty"), "newest")


def q_numeric_columns(spark, sf_dir):
    """What a model may learn from: the numeric columns of labelled bars without their targets."""
    dataset = labelled(spark, sf_dir)
    return bar_view(dataset, *labels.numeric_features(dataset))


def q_ingest_capped(spark, sf_dir):
    """Six landed files, two per trigger: three batches hold all trades."""
    landed, log, past, checkpoint = (session.shared_folder(spark, n) for n in ("landed", "log", "history", "cp"))
    raw_frames(trades(spark, sf_dir)).repartitionByRange(6, "seq").write.parquet(landed)
    frames = raw.stream_frames(spark, landed, max_files_per_trigger=2)
    _drain(ingest_stream.start(frames, log, past, checkpoint, drop_rejects=True, symbol="BTCUSDT"))
    kept = history.open_history(spark, past)
    batches = kept.agg(F.count_distinct("ingest_batch")).first()[0]
    return kept.select("seq", "ts", "price", "qty", "side", "symbol", F.lit(batches).cast("bigint").alias("batches"))


def entry(spark: SparkSession) -> DataFrame:
    """Feature bars per symbol at one minute."""
    return q_bars_full(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    if llm_queries is None:
        return own
    return own | llm_queries.queries() | {"pipeline": corpus_pipeline.run}


# --- the same in SQL ------------------------------------------------------------

_SIDE = (
    "CASE WHEN event_type IN ('purchase','click') THEN 'buy' "
    "WHEN event_type IN ('view','error') THEN 'sell' ELSE 'other' END"
)


def _ticks(symbol: str = "'SYM' || (user_id % 5)") -> str:
    return (
        "t AS (SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts, value AS price, "
        f"CAST(json_extract_string(props, '$.k') AS DOUBLE) AS qty, {_SIDE} AS side, {symbol} AS symbol FROM events)"
    )


_LINES = """t AS (SELECT (l_orderkey << 30) | (CAST(l_linenumber AS BIGINT) << 27) | l_partkey AS seq,
  epoch_us(l_shipdate) // 1000 AS ts, l_extendedprice / l_quantity AS price, l_quantity AS qty,
  CAST(l_suppkey AS VARCHAR) AS symbol FROM lineitem)"""


def _r(expr: str, name: str | None = None) -> str:
    return f"round({expr} + 1e-9::DOUBLE, 6) + 0.0 AS {name or expr}"


def _sparse_sql(step: int, divides_day: bool = True, bucket: str | None = None) -> str:
    bucket = bucket or f"ts - ts % {step}"
    source = "t"
    if not divides_day:
        source = "(SELECT t.*, o FROM t JOIN (SELECT symbol, min(ts) - min(ts) % 86400000 AS o FROM t GROUP BY symbol) d USING (symbol))"
        bucket = f"o + (ts - o) - (ts - o) % {step}"
    return f"""s AS (SELECT symbol, {bucket} AS bucket, first(price ORDER BY ts, seq) AS price_open,
  max(price) AS price_high, min(price) AS price_low, last(price ORDER BY ts, seq) AS price_close,
  sum(qty) AS volume, count(price) AS trade_count, sum(price * qty) AS notional
  FROM {source} GROUP BY ALL)"""


def _sparse_select() -> str:
    return "SELECT symbol, bucket, " + ", ".join(c if c == "trade_count" else _r(c) for c in OHLCV) + " FROM s"


def _dense_sql(step: int, windows: tuple[int, ...]) -> str:
    fill = "last_value({c} IGNORE NULLS) OVER w AS {c}"
    rolling = ",\n  ".join(
        f"avg(price_close) OVER w{k} AS ma_{k}, coalesce(stddev_samp(CASE WHEN isfinite(return_1) THEN return_1 END) OVER w{k}, 0) AS vol_{k}, avg(volume) OVER w{k} AS volumema_{k}"
        for k in windows
    )
    frames = ", ".join(
        f"w{k} AS (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)" for k in windows
    )
    prices = ("price_open", "price_high", "price_low", "price_close")
    return f"""g AS (SELECT symbol, unnest(range(min(bucket), max(bucket) + {step}, {step})) AS bucket FROM s GROUP BY symbol),
j AS (SELECT g.symbol, g.bucket, {", ".join(prices)}, coalesce(volume, 0.0) AS volume, coalesce(trade_count, 0) AS trade_count,
  CASE WHEN volume <> 0 THEN notional / volume END AS vw FROM g LEFT JOIN s ON g.symbol = s.symbol AND g.bucket = s.bucket),
f AS (SELECT symbol, bucket, {", ".join(fill.format(c=c) for c in prices)}, volume, trade_count,
  last_value(vw IGNORE NULLS) OVER w AS vw FROM j
  WINDOW w AS (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p AS (SELECT *, coalesce(vw, price_close) AS vwap, lag(price_close) OVER (PARTITION BY symbol ORDER BY bucket) AS prev FROM f),
q AS (SELECT *, CASE WHEN prev IS NULL THEN 0.0 WHEN prev = 0 AND price_close = 0 THEN 0.0
  WHEN prev = 0 THEN 'inf'::DOUBLE ELSE price_close / prev - 1 END AS return_1 FROM p),
b AS (SELECT symbol, bucket, price_close, price_open, price_high, price_low, volume, trade_count, vwap, return_1,
  {rolling} FROM q WINDOW {frames})"""


def _bars_sql(step: int, windows: tuple[int, ...], *columns: str, ticks: str | None = None, divides_day: bool = True) -> str:
    keep = columns or (
        "price_close", "price_open", "price_high", "price_low", "volume", "trade_count", "vwap", "return_1",
        *bars.feature_columns(windows),
    )
    chosen = ", ".join(c if c == "trade_count" else _r(c) for c in keep)
    return f"WITH {ticks or _ticks()}, {_sparse_sql(step, divides_day)},\n{_dense_sql(step, windows)}\nSELECT symbol, bucket, {chosen} FROM b"


def _labels_sql(step: int = MINUTE, windows: tuple[int, ...] = (3,), horizon: int = 1, threshold: str = "0.001", divides_day: bool = True) -> str:
    return f"""WITH {_ticks()}, {_sparse_sql(step, divides_day)},
{_dense_sql(step, windows)},
n AS (SELECT *, lead(price_close, {horizon}) OVER (PARTITION BY symbol ORDER BY bucket) AS nxt FROM b),
lab0 AS (SELECT *, CASE WHEN price_close = 0 THEN CASE WHEN nxt > 0 THEN 'inf'::DOUBLE END
  ELSE (nxt - price_close) / price_close END AS future_return FROM n),
lab AS (SELECT *, CASE WHEN future_return >= {threshold}::DOUBLE THEN 1 ELSE 0 END AS label FROM lab0 WHERE future_return IS NOT NULL)
"""


_OFI = """SELECT symbol, seq, ts, (b - s)::DOUBLE / greatest(b + s, 1) AS ofi FROM (
  SELECT *, sum(CASE WHEN side = 'buy' THEN 1 ELSE 0 END) OVER w AS b, sum(CASE WHEN side = 'sell' THEN 1 ELSE 0 END) OVER w AS s
  FROM t WINDOW w AS (PARTITION BY symbol ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))"""

# Trades without arrival positions: in time order, ties by price, quantity and side.
_TIME_ORDER = """t AS (SELECT * REPLACE (row_number() OVER (PARTITION BY symbol ORDER BY ts, price NULLS FIRST, qty NULLS FIRST, side NULLS FIRST) AS seq) FROM a)"""

_REPLAYED = f"""live AS ({_OFI}), heard AS (SELECT * REPLACE (CASE WHEN seq % 499 = 7 THEN 'sell' ELSE side END AS side) FROM t WHERE seq % 997 <> 5),
  once AS ({_OFI.replace("FROM t WINDOW", "FROM heard WINDOW")}), again AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE seq % 811 = 3),
  off_live AS (SELECT *, row_number() OVER (PARTITION BY symbol, seq ORDER BY ts, ofi) AS copy FROM (SELECT * FROM live EXCEPT ALL SELECT * FROM again)),
  off_again AS (SELECT *, row_number() OVER (PARTITION BY symbol, seq ORDER BY ts, ofi) AS copy FROM (SELECT * FROM again EXCEPT ALL SELECT * FROM live))"""

_SPLIT = """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bucket) > n - CAST(ceil(0.2::DOUBLE * n) AS BIGINT) AS is_test
  FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM lab)"""

_SCORE = "greatest(0.0, least(1.0, 0.5 + ofi * 0.05::DOUBLE))"
_PAYLOAD = f"ts, price, qty, side, {_r('ofi')}, {_r(_SCORE, 'prob_up')}, {_r(f'1.0 - {_SCORE}', 'prob_down')}, 'heuristic' AS predictor"
_SIGNED = "CASE WHEN side = 'buy' THEN qty ELSE -qty END"
_SCORED_TRADES = f"WITH {_ticks()}, e AS (SELECT CAST(seq AS VARCHAR) AS id, ts, price, qty, side, {_SIGNED} AS ofi FROM t) SELECT id, {_PAYLOAD} FROM e"

_BAD = "((side = 'buy' AND qty < 5) OR (side = 'sell' AND qty < 5) OR (side = 'other' AND qty < 10))"
def _browser(expr: str) -> str:
    """A browser's text of numbers that have ten decimals at most."""
    return f"regexp_replace(rtrim(format('{{:.10f}}', {expr}), '0'), '[.]$', '')"


_STRINGS = "SELECT symbol, seq, CAST(ts AS VARCHAR) AS ts, CAST(price AS VARCHAR) AS price, CAST(qty AS VARCHAR) AS qty, side FROM t"
_IN_RANGE = f"ts BETWEEN {RANGE_START} AND {RANGE_END}"

_LABEL_SCORES = _labels_sql() + f""", x AS (SELECT greatest(0.0, least(1.0, 0.5 + ({_SIGNED}) * 0.05::DOUBLE)) AS score, lab.label
  FROM t JOIN lab ON t.symbol = lab.symbol AND t.ts - t.ts % {MINUTE} = lab.bucket)"""

_NEWEST = "SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) <= "


def _axis_sql(source: str, price: bool = True) -> str:
    return f"""SELECT symbol, seq, ts, rn + greatest(0, max(ts // 1000 - rn) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)) AS axis{", price" if price else ""}
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS rn FROM {source})"""


def _dollars(expr: str, digits: int) -> str:
    return f"'$' || regexp_replace(regexp_replace(format('{{:,.{digits}f}}', round({expr}, {digits})), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"


_CHANGE = f"""c AS (SELECT symbol, last(price ORDER BY seq) AS last_price,
  CASE WHEN first(price ORDER BY seq) = 0 THEN 0 ELSE (last(price ORDER BY seq) - first(price ORDER BY seq)) / first(price ORDER BY seq) * 100 END AS change_pct
  FROM ({_NEWEST}200) GROUP BY symbol)"""


def oracle_sql() -> dict[str, str]:
    w = bars.DEFAULT_WINDOWS
    week, seven = 7 * 86_400_000, 7 * MINUTE
    own = {
        "raw_parse": f"""WITH {_ticks()} SELECT seq, CASE side WHEN 'buy' THEN 'not json' WHEN 'sell' THEN 'bad price' ELSE 'missing m' END AS reason
            FROM t WHERE {_BAD}""",
        "normalize_trade": f"WITH {_ticks()} SELECT seq, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side FROM t WHERE NOT {_BAD}",
        "normalize_dialects": f"""WITH {_ticks()}, u AS (SELECT seq, ts, price, side, CASE WHEN side = 'other' THEN qty / 100000 ELSE qty END AS qty FROM t WHERE side = 'buy' OR qty >= 5)
            SELECT seq, ts || '-' || {_browser('qty')} || '-' || {_browser('price')} || '-' || seq AS id, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side FROM u""",
        "coerce_fields": f"""WITH {_ticks()} SELECT seq, ts, price, CASE WHEN side = 'sell' THEN 0.0 ELSE qty END AS qty,
            CASE WHEN side = 'other' THEN 'buy' ELSE side END AS side, round(CASE WHEN side = 'other' THEN price / 8 ELSE 0.0 END + 1e-9::DOUBLE, 6) + 0.0 AS ofi FROM t""",
        "load_trades": f"WITH {_ticks()} SELECT seq, ts, price, qty, side, symbol FROM t WHERE symbol = 'SYM1' AND {_IN_RANGE}",
        "history_load": f"WITH {_ticks()} SELECT seq, ts, price, qty, side, symbol FROM t WHERE symbol = 'SYM3' AND {_IN_RANGE}",
        "replay_range": f"WITH {_ticks()} SELECT seq, ts, price, qty, side, row_number() OVER (ORDER BY ts, seq) AS position FROM t WHERE {_IN_RANGE}",
        "replay_strings": f"WITH {_ticks()} {_STRINGS}",
        "replay_stream": f"WITH {_ticks()} {_STRINGS.replace('side FROM', 'side, row_number() OVER (ORDER BY t.ts, seq, symbol) AS position FROM')} WHERE t.{_IN_RANGE}",
        "replay_roundtrip": f"WITH {_ticks().replace('t AS', 'a AS', 1)}, t AS (SELECT * FROM a WHERE {_IN_RANGE}) {_OFI}",
        "bars_ohlcv": f"""WITH {_ticks("'UNKNOWN'")}, {_sparse_sql(MINUTE)} {_sparse_select()}""",
        "bars_7min": f"WITH {_ticks()}, {_sparse_sql(seven, False)} {_sparse_select()}",
        "bars_ties": f"WITH {_LINES}, {_sparse_sql(week, False)} {_sparse_select()}",
        "bars_weekly": f"""WITH {_LINES}, {_sparse_sql(0, bucket="epoch_ms(date_trunc('week', make_timestamp(ts * 1000)) + INTERVAL 6 DAY)")} {_sparse_select()}""",
        "bars_monthly": f"WITH {_LINES}, {_sparse_sql(0, bucket='epoch_ms(last_day(make_timestamp(ts * 1000))::TIMESTAMP)')} {_sparse_select()}",
        "bars_dense": _bars_sql(MINUTE, w, *OHLCV),
        "bars_vwap": _bars_sql(MINUTE, w, "vwap"),
        "bars_returns": _bars_sql(MINUTE, w, "return_1"),
        "bars_rolling": _bars_sql(MINUTE, w, *bars.feature_columns(w)),
        "bars_full": _bars_sql(MINUTE, w),
        "features_saved": _bars_sql(MINUTE, w),
        "bars_full_7min": _bars_sql(seven, (2, 30), divides_day=False),
        "bars_daily": _bars_sql(86_400_000, w, ticks=_LINES),
        "ofi": f"WITH {_ticks()} {_OFI}",
        "ofi_prefix": f"WITH {_ticks()} {_OFI}",
        "ofi_single": f"""WITH {_ticks("'UNKNOWN'")} {_OFI}""",
        "ofi_chunks": f"WITH {_ticks()} {_OFI}",
        "ofi_no_seq": f"WITH {_ticks().replace('t AS', 'a AS', 1)}, {_TIME_ORDER} {_OFI}",
        "axis_no_seq": f"WITH {_ticks().replace('t AS', 'a AS', 1)}, {_TIME_ORDER} {_axis_sql('t')}",
        "log_tail": f"WITH {_ticks()} SELECT 'BTCUSDT' AS symbol, seq, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side FROM t WHERE NOT {_BAD}",
        "text_frames": f"""WITH {_ticks()}, n AS (SELECT *, row_number() OVER (ORDER BY seq) AS position FROM t)
            SELECT position, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side FROM n WHERE NOT {_BAD}""",
        "ingest_two_feeds": f"""WITH {_ticks()}, good AS (SELECT seq, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side FROM t WHERE NOT {_BAD})
            SELECT seq, ts, price, qty, side, sink FROM good, (VALUES ('log'), ('history')) s(sink)
            UNION ALL SELECT seq, NULL, NULL, NULL, CASE side WHEN 'buy' THEN 'not json' WHEN 'sell' THEN 'bad price' ELSE 'missing m' END, 'rejects' FROM t WHERE {_BAD}""",
        "ofi_stream": f"WITH {_ticks()} {_OFI}",
        "ofi_stateful": f"WITH {_ticks()} {_OFI}",
        "ingest_stream": f"WITH {_ticks()} SELECT seq, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side, 'BTCUSDT' AS symbol FROM t WHERE NOT {_BAD}",
        "heuristic_score": f"""WITH {_ticks()}, f AS (SELECT seq AS id, ts, price, CASE WHEN side = 'sell' THEN 0.0 ELSE qty END AS qty,
            CASE WHEN side = 'other' THEN 'buy' ELSE side END AS side, CASE WHEN side = 'other' THEN price / 8 ELSE 0.0 END AS given FROM t),
            e AS (SELECT *, CASE WHEN given <> 0 THEN given ELSE {_SIGNED} END AS ofi FROM f) SELECT id, {_PAYLOAD} FROM e""",
        "score_json": _SCORED_TRADES,
        "score_stream": _SCORED_TRADES,
        "labels": _labels_sql() + f"SELECT symbol, bucket, {_r('price_close')}, {_r('future_return')}, label FROM lab",
        "labels_h3": _labels_sql(seven, (3,), 3, "0.0", False) + f"SELECT symbol, bucket, {_r('future_return')}, label FROM lab",
        "labels_wide": _labels_sql(MINUTE, (3,), 5000) + f"SELECT symbol, bucket, {_r('future_return')}, label FROM lab",
        "labels_of_bars": _labels_sql() + f"SELECT symbol, bucket, {_r('price_close')}, {_r('future_return')}, label FROM lab",
        "train_model": _labels_sql()
        + f"""SELECT term, count(*) AS rows, 0.0::DOUBLE AS gradient FROM ({_SPLIT}), (VALUES ('intercept'), ('return_1'), ('vol_3'), ('ma_3')) v(term)
            WHERE NOT is_test AND isfinite(return_1) AND isfinite(vol_3) AND isfinite(ma_3) GROUP BY term""",
        "model_score": _labels_sql()
        + f""", sc AS (SELECT *, CASE WHEN price_close >= price_open THEN 1 ELSE 0 END AS up FROM ({_SPLIT})),
            shares AS (SELECT avg(label) FILTER (WHERE up = 1) AS one, avg(label) FILTER (WHERE up = 0) AS zero FROM sc WHERE NOT is_test)
            SELECT symbol, bucket, label, round(CASE WHEN up = 1 THEN one ELSE zero END + 1e-9::DOUBLE, 4) + 0.0 AS p_up,
              round(1 - CASE WHEN up = 1 THEN one ELSE zero END + 1e-9::DOUBLE, 4) + 0.0 AS p_down, round(zero + 1e-9::DOUBLE, 4) + 0.0 AS missing_up, 'model' AS predictor FROM sc, shares""",
        "chrono_split": _labels_sql()
        + """SELECT symbol, bucket, label, row_number() OVER (PARTITION BY symbol ORDER BY bucket)
            > n - CAST(ceil(0.2::DOUBLE * n) AS BIGINT) AS is_test FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM lab)""",
        "auc_rank": _LABEL_SCORES
        + """SELECT round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2) / (p * m) + 1e-9::DOUBLE, 6) + 0.0 AS roc_auc FROM (
            SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r,
              sum(label) OVER ()::DOUBLE AS p, (count(*) OVER () - sum(label) OVER ())::DOUBLE AS m FROM x) GROUP BY p, m""",
        "class_metrics": _LABEL_SCORES
        + """, y AS (SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS guess FROM x),
            z AS (SELECT avg(CASE WHEN label = guess THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy, sum(label * guess)::DOUBLE AS tp,
              sum(guess)::DOUBLE AS g, sum(label)::DOUBLE AS a FROM y)
            SELECT round(accuracy + 1e-9::DOUBLE, 6) + 0.0 AS accuracy, round(CASE WHEN g > 0 THEN tp / g ELSE 0.0 END + 1e-9::DOUBLE, 6) + 0.0 AS precision,
              round(CASE WHEN a > 0 THEN tp / a ELSE 0.0 END + 1e-9::DOUBLE, 6) + 0.0 AS recall, round(2 * tp / (g + a) + 1e-9::DOUBLE, 6) + 0.0 AS f1 FROM z""",
        "last_n": f"WITH {_ticks()} SELECT symbol, seq, ts, price, qty, side FROM ({_NEWEST}200)",
        "latest_trade": f"WITH {_ticks()} SELECT symbol, seq, ts, price, qty, side FROM ({_NEWEST}1)",
        "change_pct": f"WITH {_ticks()}, {_CHANGE} SELECT symbol, last_price, {_r('change_pct')} FROM c",
        "ticker": f"""WITH {_ticks()}, {_CHANGE} SELECT symbol, {_dollars('last_price', 2)} AS price_text,
            CASE WHEN change_pct >= 0 THEN '+' ELSE '' END || format('{{:.2f}}', round(change_pct, 2)) || '%' AS change_text FROM c""",
        "trade_feed": f"""WITH {_ticks()} SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY seq DESC)::INTEGER AS position, seq,
            strftime(make_timestamp(ts * 1000), '%H:%M:%S') AS time_text, {_dollars('price', 3)} AS price_text,
            format('{{:.6f}}', round(qty, 6)) AS qty_text, side FROM ({_NEWEST}30)""",
        "monotone_axis": f"WITH {_ticks()} {_axis_sql('t')}",
        "monotone_axis_ties": f"WITH {_LINES} {_axis_sql('t', price=False)}",
        "chart_points": f"WITH {_ticks()} {_axis_sql(f'({_NEWEST}200)')}",
        "portfolio_total": "SELECT round(coalesce(sum(c_acctbal), 0.0) + 1e-9::DOUBLE, 6) + 0.0 AS total_value FROM customer",
        "portfolio_lines": f"""SELECT symbol, quantity, {_r('value')}, {_dollars('value', 3)} AS value_text FROM (
            SELECT c_mktsegment AS symbol, CAST(count(*) AS DOUBLE) AS quantity, sum(c_acctbal) AS value FROM customer GROUP BY 1)""",
    }
    own |= {
        "features_rebuilt": _bars_sql(MINUTE, w),
        "features_job": _bars_sql(MINUTE, w, ticks=_ticks("'UNKNOWN'")),
        "history_table": f"WITH {_ticks()} SELECT symbol, CAST(ts // 86400000 AS INTEGER) AS day, count(*) AS n, {_r('sum(qty)', 'qty')}, max(seq) AS newest FROM t GROUP BY symbol, ts // 86400000",
        "numeric_columns": _labels_sql(MINUTE, w) + f"SELECT symbol, bucket, trade_count, {', '.join(_r(c) for c in (*OHLCV[:-1], 'vwap', 'return_1', *bars.feature_columns(w)))} FROM lab",
        "ingest_capped": f"WITH {_ticks()} SELECT seq, ts, price, qty, CASE WHEN side = 'buy' THEN 'buy' ELSE 'sell' END AS side, 'BTCUSDT' AS symbol, 3::BIGINT AS batches FROM t WHERE NOT {_BAD}",
        "asof_features": f"WITH {_ticks()}, {_sparse_sql(MINUTE)},\n{_dense_sql(MINUTE, (3, 5))},\ne AS (SELECT *, bucket + {MINUTE} AS closed_at FROM b)"
        f"""SELECT t.symbol, seq, ts, closed_at, {_r('price_close')}, {_r('return_1')}, {_r('ma_3')}, {_r('vol_5')}
            FROM t ASOF LEFT JOIN e ON t.symbol = e.symbol AND t.ts >= e.closed_at""",
        "asof_ties": """WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag AS flag, epoch_us(l_shipdate) // 1000 AS ts FROM lineitem),
            o AS (SELECT CASE WHEN o_orderpriority < '3' THEN 'A' WHEN o_orderpriority < '5' THEN 'N' ELSE 'R' END AS flag, epoch_us(o_orderdate) // 1000 AS ordered, max(o_orderkey) AS newest FROM orders GROUP BY ALL)
            SELECT l_orderkey, l_linenumber, l.flag, ts, ordered, newest FROM l ASOF LEFT JOIN o ON l.flag = o.flag AND l.ts >= o.ordered""",
        "asof_model_score": _labels_sql()
        + f""", sc AS (SELECT *, CASE WHEN price_close >= price_open THEN 1 ELSE 0 END AS up FROM ({_SPLIT})),
            shares AS (SELECT avg(label) FILTER (WHERE up = 1) AS one, avg(label) FILTER (WHERE up = 0) AS zero FROM sc WHERE NOT is_test),
            e AS (SELECT symbol, bucket + {MINUTE} AS closed_at, price_close >= price_open AS up FROM b)
            SELECT t.symbol, seq, round(CASE WHEN e.up THEN one ELSE zero END + 1e-9::DOUBLE, 4) + 0.0 AS prob_up, 'model' AS predictor
            FROM t ASOF LEFT JOIN e ON t.symbol = e.symbol AND t.ts >= e.closed_at, shares""",
        "replay_differences": f"""WITH {_ticks()}, {_REPLAYED} SELECT coalesce(l.symbol, r.symbol) AS symbol, coalesce(l.seq, r.seq) AS seq, coalesce(l.copy, r.copy)::BIGINT AS copy,
            CASE WHEN r.seq IS NULL THEN 'left only' WHEN l.seq IS NULL THEN 'right only' ELSE 'changed' END AS status,
            CASE WHEN l.ofi <> r.ofi THEN 'ofi' ELSE '' END AS differing, l.ofi AS live, r.ofi AS replayed FROM off_live l FULL JOIN off_again r ON l.symbol = r.symbol AND l.seq = r.seq AND l.copy = r.copy""",
        "replay_divergence": f"""WITH {_ticks()}, {_REPLAYED}, j AS (SELECT l.seq AS a, r.seq AS b, l.ofi <> r.ofi AS differs FROM off_live l FULL JOIN off_again r ON l.symbol = r.symbol AND l.seq = r.seq AND l.copy = r.copy)
            SELECT 'equal' AS subject, (SELECT count(*) FROM live) - count(*) FILTER (WHERE a IS NOT NULL) AS rows FROM j
            UNION ALL SELECT 'changed', count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) FROM j
            UNION ALL SELECT 'left only', count(*) FILTER (WHERE b IS NULL) FROM j UNION ALL SELECT 'right only', count(*) FILTER (WHERE a IS NULL) FROM j
            UNION ALL SELECT 'column: ts', 0 UNION ALL SELECT 'column: ofi', count(*) FILTER (WHERE differs) FROM j""",
        "stream_accuracy": _LABEL_SCORES.replace("AS score, lab.label", "AS score, lab.label, t.symbol, ts")
        + """ SELECT symbol, ts - ts % 86400000 AS window, count(*) AS n, sum(CASE WHEN (score >= 0.5) = (label = 1) THEN 1 ELSE 0 END)::BIGINT AS hits,
            round(avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0 END) + 1e-9::DOUBLE, 6) + 0.0 AS accuracy FROM x GROUP BY ALL""",
        "stream_volatility": f"WITH {_ticks()}, {_sparse_sql(MINUTE)},\n{_dense_sql(MINUTE, w)},\n"
        f"""k AS (SELECT symbol, max(bucket) AS newest FROM s WHERE bucket + {MINUTE} <= (SELECT max(ts) FROM t) - 1800000 GROUP BY symbol)
            SELECT symbol, bucket, {_r('price_close')}, {_r('return_1')}, {_r('vol_3')}, {_r('vol_5')}, {_r('vol_15')} FROM b JOIN k USING (symbol) WHERE bucket <= newest""",
    }
    delays = f"""d AS (SELECT epoch_us(o_orderdate) // 1000 AS ts, (epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000) / 86400000.0::DOUBLE + l_linenumber / 8.0::DOUBLE AS latency FROM lineitem JOIN orders ON l_orderkey = o_orderkey), x AS (SELECT ts - ts % {MONTH} AS window, latency::DOUBLE AS v FROM d)"""
    ratio = "(1.01::DOUBLE / 0.99::DOUBLE)"
    curve = _labels_sql() + """, held AS (SELECT *, CASE WHEN return_1 > 0 THEN 1.0::DOUBLE WHEN return_1 < 0 THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END AS position FROM lab),
            gains AS (SELECT *, (position * CASE WHEN isfinite(future_return) THEN future_return ELSE 0 END - abs(position) * 0.001::DOUBLE) * 0.01::DOUBLE AS earned FROM held),
            curves AS (SELECT *, product(1 + earned) OVER (PARTITION BY symbol ORDER BY bucket) AS equity FROM gains),
            falls AS (SELECT *, equity / greatest(1, max(equity) OVER (PARTITION BY symbol ORDER BY bucket)) - 1 AS drawdown FROM curves) """
    own |= {
        "latency_exact": f"""WITH {delays} SELECT "window", 0.5::DOUBLE AS probability, round(quantile_cont(v, 0.5::DOUBLE) + 1e-9::DOUBLE, 6) + 0.0 AS value FROM x GROUP BY "window"
            UNION ALL SELECT "window", 0.95::DOUBLE, round(quantile_cont(v, 0.95::DOUBLE) + 1e-9::DOUBLE, 6) + 0.0 FROM x GROUP BY "window" """,
        "stream_latency": f"""WITH {delays}, g AS (SELECT "window", CASE WHEN v = 0 THEN 0 ELSE sign(v) * (ceil(ln(abs(v)) / ln({ratio})) + 1000000) END AS bin, count(*) AS n FROM x GROUP BY ALL),
            k AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY "window" ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY "window") AS total FROM g)
            SELECT "window", p AS probability, round(CASE WHEN bin = 0 THEN 0 ELSE sign(bin) * exp((abs(bin) - 1000000) * ln({ratio})) * 2 / ({ratio} + 1) END + 1e-9::DOUBLE, 6) + 0.0 AS value
            FROM k, (VALUES (0.5::DOUBLE), (0.95::DOUBLE)) q(p) WHERE before <= floor(p * (total - 1)) AND floor(p * (total - 1)) < before + n""",
        "stream_throughput": f"""WITH {_ticks()}, c AS (SELECT symbol, ts - ts % {MINUTE} AS second, count(*) AS n FROM t GROUP BY ALL),
            g AS (SELECT symbol, unnest(range(min(second), max(second) + {MINUTE}, {MINUTE})) AS second FROM c GROUP BY symbol)
            SELECT symbol, second, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (symbol, second)""",
        "backtest_curve": curve + f"SELECT symbol, bucket, {_r('position')}, {_r('CASE WHEN equity > 0 THEN ln(equity) END', 'log_equity')}, {_r('drawdown')} FROM falls",
        "backtest_summary": curve + f"""SELECT symbol, count(*) AS bars, count(*) FILTER (WHERE position <> 0) AS trades, count(*) FILTER (WHERE position <> 0 AND earned > 0) AS wins,
            {_r('CASE WHEN last(equity ORDER BY bucket) > 0 THEN ln(last(equity ORDER BY bucket)) END', 'log_equity')}, {_r('min(drawdown)', 'worst_drawdown')} FROM falls GROUP BY symbol""",
        "correlations": f"WITH {_ticks()}, {_sparse_sql(MINUTE)},\n{_dense_sql(MINUTE, (3,))},\nfin AS (SELECT symbol, bucket, bucket - bucket % 86400000 AS window, return_1 AS v FROM b WHERE isfinite(return_1))"
        """, pairs AS (SELECT x.window, x.symbol, y.symbol AS other, count(*) AS n, stddev_pop(x.v) AS sx, stddev_pop(y.v) AS sy, covar_pop(x.v, y.v) AS c
            FROM fin x JOIN fin y ON x.bucket = y.bucket AND x.symbol < y.symbol GROUP BY ALL)
            SELECT pairs."window", symbol, other, n, CASE WHEN sx > 0 AND sy > 0 THEN round(c / (sx * sy) + 1e-9::DOUBLE, 6) + 0.0 END AS correlation FROM pairs""",
    }
    if llm_queries is None:
        return own
    found = own | llm_queries.oracle_sql()
    return found if corpus_pipeline.ORACLE_SQL is None else found | {"pipeline": corpus_pipeline.ORACLE_SQL}
