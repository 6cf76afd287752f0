"""Logistic regression on labelled bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import labels, metrics
from .scoring import Bundle, score

MAX_ITERATIONS = 500


def _check(dataset: DataFrame, feature_cols: Sequence[str]) -> int:
    """Number of training rows, after the checks the solver would fail on."""
    def unusable(name: str):
        value = F.col(name).cast("double")
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    train = ~F.col("is_test")
    row = dataset.agg(
        F.sum(train.cast("bigint")).alias("n"),
        F.min(F.when(train, F.col("label"))).alias("low"),
        F.max(F.when(train, F.col("label"))).alias("high"),
        *[F.sum(unusable(c).cast("bigint")).alias(f"bad_{i}") for i, c in enumerate(feature_cols)],
    ).first()
    bad = [c for i, c in enumerate(feature_cols) if row[f"bad_{i}"]]
    if bad:
        raise ValueError(f"features hold missing or infinite values: {', '.join(bad)}")
    if not row["n"]:
        raise ValueError("no training rows")
    if row["low"] == row["high"]:
        raise ValueError("training rows hold one class only")
    return row["n"]


def usable(dataset: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Rows whose features are all there and finite."""
    kept = dataset
    for name in feature_cols:
        value = F.col(name).cast("double")
        kept = kept.where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    return kept


def train(
    dataset: DataFrame, feature_cols: Sequence[str], C: float = 1.0, unusable: str = "refuse"
) -> tuple[Bundle, dict[str, float]]:
    """Fit on the earlier 80 % of labelled bars, measure on the rest.

    Rows with missing or infinite features (the return after a zero price) fail
    the job, or with ``unusable="drop"`` have no part in fit and test.
    L2 penalty of strength 1/C on unscaled inputs, intercept not penalised.
    Spark averages the loss over rows, so the penalty is divided by their number.
    """
    feature_cols = tuple(feature_cols)
    if not feature_cols:
        raise ValueError("no feature columns")
    keep = [c for c in ("symbol", "timestamp") if c in dataset.columns]
    written = materialize(dataset.select(*keep, *feature_cols, "label"), "labelled")
    split = labels.chrono_split(written).select(*feature_cols, "label", "is_test")
    if unusable == "drop":
        split = usable(split, feature_cols)
    # Read by the checks, the fit and the test.
    split = materialize(split, "split")
    rows = _check(split, feature_cols)
    stages = [
        VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error"),
        LogisticRegression(
            maxIter=MAX_ITERATIONS,
            regParam=1.0 / (C * rows),
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=True,
            tol=1e-10,
        ),
    ]
    model = Pipeline(stages=stages).fit(split.where(~F.col("is_test")))
    bundle = Bundle(model, feature_cols)
    tested = score(split.where("is_test"), bundle)
    return bundle, metrics.evaluate(tested)
