"""Compare two frames that should hold the same rows, such as live and replayed features.

Rows are equal or not as a whole first: both sides are counted by all their columns,
and what is there as often on both sides is done with. Only what is left is paired,
key by key, copy by copy, to tell which columns differ. Ranks of copies come from
counts per stretch of row hashes, so that no key is one task's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import ordered

CHANGED, LEFT_ONLY, RIGHT_ONLY = "changed", "left only", "right only"
# The upper bits of a row's hash that name its stretch: 2**12 for each key.
STRETCH_BITS = 12


def _counted(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with their surplus on the left (positive) or right (negative); equal ones go."""
    sides = [df.select(*columns, F.lit(sign).cast("bigint").alias("_n")) for df, sign in ((left, 1), (right, -1))]
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)


def _copies(surplus: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row for each copy, numbered from 1 within its key and side."""
    sided = surplus.withColumns(
        {"_left": F.col("_n") > 0, "_n": F.abs("_n"), "_hash": F.xxhash64(*columns), "_stretch": F.shiftright(F.xxhash64(*columns), 64 - STRETCH_BITS)}
    )
    group = [*keys, "_left"]
    before = ordered.offsets(sided, group, "_stretch", {"_before": F.col("_n")})
    within = Window.partitionBy(*group, "_stretch").orderBy("_hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = sided.withColumn("_place", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    same = [F.col(f"p.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in (*group, "_stretch")]
    condition = same[0]
    for one in same[1:]:
        condition &= one
    joined = placed.alias("p").join(before.alias("b"), condition).select("p.*", "b._before")
    first = F.col("_before") + F.col("_place")
    return joined.withColumn("copy", F.explode(F.sequence(first + 1, first + F.col("_n")))).select(*columns, "_left", "copy")


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, copy, status, differing, left, right): every row that has no equal on the other side.

    Compared are the columns of `left`, which `right` must have too; others of `right`
    have no part. NULL equals NULL, as key and as value, and NaN equals NaN. Rows that
    are there more often on one side leave their surplus. Surplus copies of a key are
    paired by number: with both sides there, `differing` names the unequal columns,
    else `status` tells the only side. `left` and `right` are the rows' other columns.
    """
    columns = list(left.columns)
    values = [c for c in columns if c not in keys]
    if not values:
        raise ValueError("no column to compare beside the keys")
    each = _copies(_counted(left, right, columns), keys, columns)
    row = F.struct(*[F.col(f"`{c}`") for c in values])
    sides = {
        name: each.where(F.col("_left") == flag).select(*[F.col(f"`{k}`").alias(f"_{name}{i}") for i, k in enumerate(keys)], F.col("copy").alias(f"_{name}_copy"), row.alias(name))
        for name, flag in (("left", True), ("right", False))
    }
    condition = F.col("_left_copy") == F.col("_right_copy")
    for i in range(len(keys)):
        condition &= F.col(f"_left{i}").eqNullSafe(F.col(f"_right{i}"))
    joined = sides["left"].join(sides["right"], condition, "full_outer")
    names = [F.when(~F.col(f"left.`{c}`").eqNullSafe(F.col(f"right.`{c}`")), F.lit(c)) for c in values]
    there, here = F.col("_left_copy").isNotNull(), F.col("_right_copy").isNotNull()
    status = F.when(~here, LEFT_ONLY).when(~there, RIGHT_ONLY).otherwise(CHANGED)

    def either(a: str, b: str) -> Column:
        return F.when(there, F.col(a)).otherwise(F.col(b))

    return joined.select(
        *[either(f"_left{i}", f"_right{i}").alias(k) for i, k in enumerate(keys)],
        either("_left_copy", "_right_copy").alias("copy"),
        status.alias("status"),
        F.when(there & here, F.array_compact(F.array(*names))).otherwise(F.array().cast("array<string>")).alias("differing"),
        "left",
        "right",
    )


def report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(subject, rows): what `differences` found, one row per status and per column.

    `equal` counts the pairs of equal rows, `changed`, `left only` and `right only` the
    others, and `column: NAME` in how many changed rows that column differs. All
    subjects are there, with 0 where nothing was found.
    """
    values = [c for c in left.columns if c not in keys]
    found = differences(left, right, keys)
    subjects = F.concat(F.array("status"), F.transform("differing", lambda c: F.concat(F.lit("column: "), c)))
    counted = found.select(F.explode(subjects).alias("subject")).groupBy("subject").agg(F.count(F.lit(1)).alias("rows"))
    total = left.agg(F.count(F.lit(1)).alias("_total"))
    unmatched = counted.where(F.col("subject").isin(CHANGED, LEFT_ONLY)).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_off"))
    listed = [CHANGED, LEFT_ONLY, RIGHT_ONLY, *[f"column: {c}" for c in values]]
    every = left.sparkSession.createDataFrame([(s,) for s in listed], "subject string")
    # Two frames of one row each.
    equal = total.withColumn("_one", F.lit(1)).join(unmatched.withColumn("_one", F.lit(1)), "_one")
    equal = equal.select(F.lit("equal").alias("subject"), (F.col("_total") - F.col("_off")).alias("rows"))
    return every.join(counted, "subject", "left").select("subject", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")).unionByName(equal)
