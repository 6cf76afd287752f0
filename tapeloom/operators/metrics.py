"""Quality of binary predictions: accuracy, precision, recall, F1, ROC-AUC."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# Ranges of scores for the AUC scan. Bounds the quantiles that reach the driver.
SCORE_RANGES = 1024
DECISION = 0.5


def predicted(prob: Column) -> Column:
    """Class 1 from probability 0.5 on."""
    return F.when(prob >= DECISION, 1).otherwise(0)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def score_counts(scored: DataFrame, label: str = "label", prob: str = "prob_up") -> DataFrame:
    """Rows of class 1 (``pos``) and of other classes (``neg``) per distinct score."""
    truth = F.col(label) == 1
    return scored.groupBy(F.col(prob).cast("double").alias("score")).agg(
        F.sum(truth.cast("bigint")).alias("pos"), F.sum((~truth).cast("bigint")).alias("neg")
    )


def _class_metrics(counts: DataFrame) -> DataFrame:
    guess = predicted(F.col("score"))
    pos, neg, zero = F.col("pos"), F.col("neg"), F.lit(0).cast("bigint")
    sums = counts.agg(
        F.sum(pos + neg).alias("n"),
        F.sum(F.when(guess == 1, pos).otherwise(neg)).alias("hit"),
        F.sum(F.when(guess == 1, pos).otherwise(zero)).alias("tp"),
        F.sum(F.when(guess == 1, pos + neg).otherwise(zero)).alias("guessed"),
        F.sum(pos).alias("actual"),
    )
    tp, guessed, actual = F.col("tp"), F.col("guessed"), F.col("actual")
    seen = (guessed + actual) > 0
    return sums.select(
        F.try_divide(F.col("hit").cast("double"), F.col("n").cast("double")).alias("accuracy"),
        F.when(seen, _ratio(tp, guessed)).alias("precision"),
        F.when(seen, _ratio(tp, actual)).alias("recall"),
        F.when(seen, _ratio(tp * 2, guessed + actual)).alias("f1"),
    )


def class_metrics(scored: DataFrame, label: str = "label", prob: str = "prob_up") -> DataFrame:
    """One row of accuracy, precision, recall and F1 of class 1.

    Zero denominators give 0. The last three are NULL when class 1 occurs in
    neither truth nor prediction.
    """
    truth = F.col(label) == 1
    # Straight from the rows: no need to group by score first.
    return _class_metrics(
        scored.select(
            F.col(prob).alias("score"), truth.cast("bigint").alias("pos"), (~truth).cast("bigint").alias("neg")
        )
    )


def _roc_auc(counts: DataFrame) -> DataFrame:
    """AUC of a written table of counts per distinct score.

    Ranges of scores, cut at approximate quantiles of the distinct scores so
    that none is much larger than the others, are ranked apart and joined by
    running totals per range.
    """
    cuts = counts.approxQuantile("score", [i / SCORE_RANGES for i in range(1, SCORE_RANGES)], 1 / (4 * SCORE_RANGES))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) > 2:
        ranged = Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(counts)
    else:
        ranged = counts.withColumn("range", F.lit(0.0))

    def before(part: str, order: str):
        return Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    zero = F.lit(0).cast("bigint")
    # At most SCORE_RANGES rows meet in this window over everything.
    starts = (
        ranged.groupBy("range")
        .agg(F.sum("neg").alias("neg_in"))
        .withColumn("one", F.lit(0))
        .select("range", F.coalesce(F.sum("neg_in").over(before("one", "range")), zero).alias("start"))
    )
    below = F.col("start") + F.coalesce(F.sum("neg").over(before("range", "score")), zero)
    # Twice the pairs a score's positives win, ties as one half, exact as decimals.
    won = F.col("pos").cast("decimal(19,0)") * (below * 2 + F.col("neg")).cast("decimal(19,0)")
    wins = ranged.join(starts, "range").select("pos", "neg", won.alias("won"))
    total = wins.agg(F.sum("won").alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double") * 2
    return total.select(F.try_divide(F.col("won").cast("double"), pairs).alias("roc_auc"))


def roc_auc(scored: DataFrame, label: str = "label", prob: str = "prob_up") -> DataFrame:
    """Exact ROC-AUC with mid-ranks for ties, as one row; NULL for one class."""
    return _roc_auc(materialize(score_counts(scored, label, prob), "score-counts"))


def evaluate(scored: DataFrame, label: str = "label", prob: str = "prob_up") -> dict[str, float]:
    """Metrics as a plain dict; keys without a value are left out."""
    counts = materialize(score_counts(scored, label, prob), "score-counts")
    row = {**_roc_auc(counts).first().asDict(), **_class_metrics(counts).first().asDict()}
    return {k: v for k, v in row.items() if v is not None}
