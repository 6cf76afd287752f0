import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import bars, labels, metrics, normalize, scoring, training
from tapeloom.plans import build_features, train_model
from tapeloom.sources import history, models, paths


def entries(spark, rows):
    df = spark.createDataFrame(rows, "id string, fields map<string,string>")
    return normalize.coerce_fields(df)


def test_payload_without_model(spark):
    scored = scoring.payload(
        entries(
            spark,
            [
                ("1-0", {"ts": "1700000000000", "price": "64000.0", "qty": "0.01", "side": "buy"}),
                ("1-1", {"qty": "25", "side": "buy"}),
                ("1-2", {"qty": "25", "side": "sell"}),
                ("1-3", {"ofi": "-0.4"}),
                ("1-4", {}),
                ("1-5", {"ofi": "nan"}),
            ],
        )
    )
    got = {r["id"]: r for r in scored.collect()}
    first = got["1-0"]
    assert (first["ofi"], first["prob_up"], first["prob_down"], first["predictor"]) == (
        0.01, pytest.approx(0.5005), pytest.approx(0.4995), "heuristic",
    )
    assert got["1-1"]["prob_up"] == 1.0 and got["1-2"]["prob_up"] == 0.0
    assert got["1-3"]["prob_up"] == pytest.approx(0.48)
    assert got["1-4"]["prob_up"] == 0.5 and got["1-5"]["prob_up"] == 1.0
    texts = [json.loads(r["value"]) for r in scoring.payload_json(scored).collect()]
    assert list(texts[0]) == list(scoring.PAYLOAD)
    assert texts[0]["id"] == "1-0" and texts[0]["ts"] == 1700000000000


def test_heuristic_defaults_for_absent_columns(spark):
    row = scoring.heuristic(spark.range(1)).first()
    assert (row["prob_up"], row["prob_down"]) == (0.5, 0.5)


@pytest.fixture(scope="module")
def dataset(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(5, 2)
        label = int(rng.random() < 1 / (1 + math.exp(-(1.2 * a - 0.5 * (b - 5)))))
        rows.append((1700000000000 + 60_000 * i, a, b, label))
    return spark.createDataFrame(rows, "ms bigint, a double, b double, label int").withColumn("timestamp", F.timestamp_millis("ms"))


def test_coefficients_match_newton(dataset):
    bundle, quality = training.train(dataset, ("a", "b"), C=0.7)
    data = np.array([(r["a"], r["b"], r["label"]) for r in dataset.orderBy("ms").collect()][:320])
    x, y = np.column_stack([data[:, :2], np.ones(len(data))]), data[:, 2]
    penalty, w = np.diag([1.0, 1.0, 0.0]), np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = 0.7 * x.T @ (p - y) + penalty @ w
        w -= np.linalg.solve(0.7 * (x.T * (p * (1 - p))) @ x + penalty, gradient)
    fitted = bundle.model.stages[-1]
    np.testing.assert_allclose([*fitted.coefficients, fitted.intercept], w, atol=1e-5)
    assert set(quality) == {"roc_auc", "accuracy", "precision", "recall", "f1"}
    assert 0.5 < quality["accuracy"] <= 1


def test_model_scoring_fills_missing_inputs(spark, dataset, folder):
    bundle, quality = training.train(dataset, ("a", "b"))
    path = models.save_model(spark, bundle, folder("m"), {"metrics": quality})
    loaded = models.load_model(spark, path)
    assert loaded.feature_cols == ("a", "b")
    assert models.load_metadata(spark, path)["metrics"] == quality
    assert models.load_model(spark, folder("none")) is None
    # A second save is another version; the newest counts, with its own columns.
    models.save_model(spark, training.train(dataset, ("a",))[0], path, {"metrics": {}})
    assert models.load_model(spark, path).feature_cols == ("a",)
    models.save_model(spark, bundle, path, {"metrics": quality})
    loaded = models.load_model(spark, path)
    assert loaded.feature_cols == ("a", "b")
    # Neither input is there: a constant, from the intercept alone.
    row = scoring.score(spark.createDataFrame([("x", 1.0)], "id string, qty double"), loaded).first()
    expected = 1 / (1 + math.exp(-bundle.model.stages[-1].intercept))
    assert row["predictor"] == "model" and row["prob_up"] == pytest.approx(expected)
    assert row["prob_up"] + row["prob_down"] == pytest.approx(1)
    assert scoring.score(spark.range(1), scoring.Bundle(loaded.model, ())).first()["predictor"] == "heuristic"


def test_training_refuses_bad_data(spark, dataset):
    with pytest.raises(ValueError, match="one class"):
        training.train(dataset.withColumn("label", F.lit(1)), ("a",))
    with pytest.raises(ValueError, match="infinite values: a"):
        training.train(dataset.withColumn("a", F.lit(float("inf"))), ("a", "b"))
    with pytest.raises(ValueError, match="infinite values: b"):
        training.train(dataset.withColumn("b", F.lit(None).cast("double")), ("a", "b"))
    with pytest.raises(ValueError, match="no training rows"):
        training.train(dataset.limit(0), ("a",))


def test_numeric_features(ten_trades):
    data = labels.build_targets(bars.compute(ten_trades, windows=(3,)))
    assert labels.numeric_features(data) == (
        "price_close", "price_open", "price_high", "price_low", "volume", "trade_count", "vwap", "return_1",
        "ma_3", "vol_3", "volumema_3",
    )


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("scores", [3, 50, 100_000])
def test_auc_and_class_metrics_match_brute_force(spark, scores):
    rng = random.Random(scores)
    rows = [(rng.randrange(scores) / scores, rng.randrange(2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "prob_up double, label int")
    quality = metrics.evaluate(df)
    assert quality["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    tp = sum(s >= 0.5 and y == 1 for s, y in rows)
    guessed, actual = sum(s >= 0.5 for s, _ in rows), sum(y for _, y in rows)
    assert quality["accuracy"] == pytest.approx(sum((s >= 0.5) == (y == 1) for s, y in rows) / len(rows))
    assert quality["precision"] == pytest.approx(tp / guessed)
    assert quality["recall"] == pytest.approx(tp / actual)
    assert quality["f1"] == pytest.approx(2 * tp / (guessed + actual))


def test_metrics_without_class_one(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "prob_up double, label int")
    assert metrics.evaluate(df) == {"accuracy": 1.0}
    missed = spark.createDataFrame([(0.1, 1), (0.2, 0)], "prob_up double, label int")
    assert metrics.evaluate(missed)["precision"] == 0.0


def test_jobs_from_history_to_model(spark, trades_of, folder):
    rng = random.Random(8)
    price, rows = 100.0, []
    for i in range(400):
        price *= 1 + rng.gauss(0, 0.004)
        rows.append((1700000000000 + 30_000 * i, price, 1 + rng.random(), rng.choice(["buy", "sell"])))
    history.append(trades_of(rows), folder("trades"))
    output = build_features.main(["BTCUSDT", "--db", folder("trades"), "--outdir", folder("features")], spark)
    assert output == paths.features_path(folder("features"), "BTCUSDT", "1min")
    assert output.endswith("btcusdt_1min.parquet")
    saved, quality = train_model.main(["BTCUSDT", "--features-dir", folder("features"), "--model-dir", folder("models")], spark)
    assert saved.endswith("btcusdt_1min_h1") and 0 <= quality["accuracy"] <= 1
    meta = models.load_metadata(spark, saved)
    assert (meta["symbol"], meta["horizon"], meta["threshold"], meta["feature_path"]) == ("BTCUSDT", 1, 0.001, output)
    assert meta["feature_cols"][0] == "price_close" and meta["metrics"] == quality
    with pytest.raises(ValueError, match="no features"):
        build_features.main(["BTCUSDT", "--db", folder("trades"), "--outdir", folder("f2"), "--start-ts", "1"] + ["--end-ts", "2"], spark)
    with pytest.raises(FileNotFoundError):
        build_features.main(["BTCUSDT", "--db", folder("missing")], spark)
    with pytest.raises(FileNotFoundError):
        train_model.main(["BTCUSDT", "--features", folder("missing")], spark)
