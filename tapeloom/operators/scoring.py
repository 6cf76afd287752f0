"""Up/down probabilities per trade, from a fitted model or a fixed rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

# Neutral probability and its change per unit of bias.
NEUTRAL = 0.5
PER_UNIT = 0.05

PAYLOAD = ("id", "ts", "price", "qty", "side", "ofi", "prob_up", "prob_down", "predictor")


@dataclass(frozen=True)
class Bundle:
    """A fitted model and the columns it was trained on, in order."""

    model: PipelineModel
    feature_cols: tuple[str, ...]


def signed_quantity(qty: Column, side: Column) -> Column:
    return F.when(side == "buy", qty).otherwise(-qty)


def flow_or_quantity(ofi: Column, qty: Column, side: Column) -> Column:
    """``ofi`` unless it is zero, then the signed quantity."""
    return F.when(ofi != 0, ofi).otherwise(signed_quantity(qty, side))


def _input(df: DataFrame, name: str, default: object, kind: str) -> Column:
    """A column, or its default where the column or the value is absent."""
    default_lit = F.lit(default).cast(kind)
    return F.coalesce(F.col(name).cast(kind), default_lit) if name in df.columns else default_lit


def heuristic(df: DataFrame) -> DataFrame:
    bias = flow_or_quantity(
        _input(df, "ofi", 0.0, "double"), _input(df, "qty", 0.0, "double"), _input(df, "side", "buy", "string")
    )
    up = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(NEUTRAL) + bias * PER_UNIT))
    return (
        df.withColumn("prob_up", up)
        .withColumn("prob_down", F.lit(1.0) - F.col("prob_up"))
        .withColumn("predictor", F.lit("heuristic"))
    )


def score(df: DataFrame, bundle: Bundle | None = None) -> DataFrame:
    """Add ``prob_up, prob_down, predictor``.

    The model is used when there is one with a non-empty column list; inputs it
    misses count as 0. Otherwise the rule on flow and signed quantity applies.
    """
    if bundle is None or not bundle.feature_cols:
        return heuristic(df)
    # The model reads clean copies of its inputs, so the frame keeps its own columns.
    own = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    packed = df.select(own, *[_input(df, c, 0.0, "double").alias(c) for c in bundle.feature_cols])
    both = vector_to_array("probability")
    return (
        bundle.model.transform(packed)
        .select("_row.*", both.getItem(1).alias("prob_up"), both.getItem(0).alias("prob_down"))
        .withColumn("predictor", F.lit("model"))
    )


def payload(entries: DataFrame, bundle: Bundle | None = None) -> DataFrame:
    """Scored trades with the published columns; zero flow becomes signed quantity."""
    prepared = entries.withColumn("ofi", flow_or_quantity(F.col("ofi"), F.col("qty"), F.col("side")))
    return score(prepared, bundle).select(*PAYLOAD)


def payload_json(scored: DataFrame) -> DataFrame:
    """One JSON text per scored trade, nulls included, in the published key order."""
    return scored.select(F.to_json(F.struct(*PAYLOAD), {"ignoreNullFields": "false"}).alias("value"))
