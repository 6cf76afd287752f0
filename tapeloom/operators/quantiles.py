"""Quantiles per group from a sketch that merges by adding, and exactly by means of it.

The sketch counts values by bins whose bounds grow by a fixed ratio, so any quantile
is told within a relative error and parts from anywhere add up. The exact form uses it
as an index: it tells which bin holds a rank, and only the values of that bin are
counted one by one. So a group of any size spreads over the cluster both ways.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Relative error of a sketch.
ACCURACY = 0.01
# Median and 95th percentile.
PROBABILITIES = (0.5, 0.95)


def _ratio(accuracy: float) -> float:
    if not 0 < accuracy < 1:
        raise ValueError("accuracy must lie between 0 and 1")
    return (1 + accuracy) / (1 - accuracy)


def _bin(value: Column, accuracy: float) -> Column:
    """Bins in order of values: 0 for zero, by ratio on both sides of it."""
    size = F.ceil(F.ln(F.abs(value)) / math.log(_ratio(accuracy))).cast("int")
    # Exponents of doubles lie within +-1100 / ln(ratio); moved up, so that signs part them.
    moved = size + F.lit(int(1100 / math.log(_ratio(accuracy))) + 2)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("int") * moved)


def _middle(place: Column, accuracy: float) -> Column:
    """A value within the relative error of all in the bin."""
    ratio = _ratio(accuracy)
    size = F.abs(place) - F.lit(int(1100 / math.log(ratio)) + 2)
    return F.when(place == 0, F.lit(0.0)).otherwise(F.signum(place) * F.exp(size * math.log(ratio)) * (2 / (ratio + 1)))


def _values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    number = F.col(value).cast("double")
    return df.select(*groups, number.alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value") & (F.abs("_value") < float("inf")))


def sketch(df: DataFrame, groups: Sequence[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """(groups, bin, n): how many finite values each bin has; others are left out."""
    return _values(df, groups, value).groupBy(*groups, _bin(F.col("_value"), accuracy).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merged(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One sketch of many of the same accuracy."""
    return parts.groupBy(*groups, "bin").agg(F.sum("n").alias("n"))


def _ranked(found: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bins with the number of values before them and in all; some thousand bins a group."""
    line = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("n").over(line.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumns({"_before": before, "_total": F.sum("n").over(line)})


def _asked(probabilities: Sequence[float]) -> Column:
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    return F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))


def estimated(found: DataFrame, groups: Sequence[str], probabilities: Sequence[float] = PROBABILITIES, accuracy: float = ACCURACY) -> DataFrame:
    """(groups, probability, value) from a sketch.

    The value of rank floor(p * (n - 1)), within the sketch's relative error.
    """
    each = _ranked(found, groups).withColumn("probability", _asked(probabilities))
    rank = F.floor(F.col("probability") * (F.col("_total") - 1))
    return each.where((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("n"))).select(*groups, "probability", _middle(F.col("bin"), accuracy).alias("value"))


def exact(df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float] = PROBABILITIES, accuracy: float = ACCURACY) -> DataFrame:
    """(groups, probability, value): the quantile at p * (n - 1), between two neighbours by proportion.

    NULL groups are a group; groups without a finite value have no row.
    """
    place = F.col("probability") * (F.col("_total") - 1)
    each = _ranked(sketch(df, groups, value, accuracy), groups).withColumn("probability", _asked(probabilities))
    each = each.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
    wanted = each.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("n")))
    names = [f"_group{i}" for i in range(len(groups))]
    wanted = wanted.select(
        *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)], F.col("bin").alias("_in"), "probability", (F.col("_rank") - F.col("_before")).alias("_inside"),
        (place - F.floor(place)).alias("_part"), (F.col("_rank") == F.floor(place)).alias("_low"),
    )
    same = F.col("bin") == F.col("_in")
    for group, name in zip(groups, names, strict=True):
        same &= F.col(group).eqNullSafe(F.col(name))
    binned = _values(df, groups, value).withColumn("bin", _bin(F.col("_value"), accuracy))
    held = binned.join(wanted.select(*names, "_in").distinct(), same, "left_semi")
    counts = held.groupBy(*groups, "bin", "_value").agg(F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy(*groups, "bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_upto", F.sum("_n").over(line))
    at = same & (F.col("_upto") - F.col("_n") <= F.col("_inside")) & (F.col("_inside") < F.col("_upto"))
    found = counts.join(wanted, at).groupBy(*groups, "probability")
    low, high = F.min("_value"), F.max("_value")
    return found.agg((low + (high - low) * F.max("_part")).alias("value"))
