"""Mix sources to target weights.

Every document gets a hash-random key. Within a source, documents stand in the
order (key, id, size); running totals of sizes along that order are cut exactly
where the source's budget ends. The order is cut into ranges of the key with
fixed bounds (its first hex digits): totals per range, running totals over the
ranges, and only the range that holds the cut is ordered row by row. What comes
out is one small row per source, which decides about each document on its own,
so texts are never shuffled and nothing depends on how rows lie in files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import common

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
#: Hex digits of the key that name a range: 4,096 ranges for each source, whose totals one task adds up.
DIGITS = 3
#: Files of the table with a row per source.
FILES = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("bigint")


def random_key(identity: Column) -> Column:
    return F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary"))


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`target` for rows (source, source_size), one for each source.

    Sources by code point, NULL last, take the weights in turn and share
    `share` of all sizes; a target stops at `most` times its source's size and
    the excess goes to the others by weight. All targets are then
    least(cap, level * weight) with one common level: walking up the sources by
    cap / weight, it is the first level that the next cap does not undercut.
    The two windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1))
    weighted = weighted.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * F.lit(float(share))
    leveled = weighted.withColumn("level", (budget - below) / above)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(everywhere)
    target = F.least(F.col("cap"), F.coalesce(first * F.col("weight"), F.col("cap")))
    return leveled.select("source", "source_size", target.alias("target"))


def sized(docs: DataFrame, identity: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(id, source, size, key) of every document."""
    return docs.select(
        F.col(identity).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), random_key(F.col(identity)).alias("key")
    )


def cuts(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: (source, source_size, target, epochs, cut, part).

    A document whose place (key, id, size) lies before `cut` is taken
    epochs + 1 times, one after it `epochs` times, one at it `epochs` times and
    `part` words more. Repeated rows share a place; what is left for the place
    is then divided among them evenly, rounded down.
    """
    ranged = sizes.withColumn("range", F.substring("key", 1, DIGITS))
    ranges = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    budgets = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("bigint")
    budgets = budgets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))

    along = Window.partitionBy("source").orderBy("range")
    running = ranges.withColumn("before", F.sum("range_size").over(along) - F.col("range_size"))
    # <=> keeps the NULL source.
    held = running.alias("r").join(budgets.alias("b"), F.expr("r.source <=> b.source")).where(
        "rest > 0 AND before < rest AND before + range_size >= rest"
    )
    held = held.select(F.col("b.source").alias("held"), F.col("range").alias("held_range"), "before", "rest")
    places = (
        ranged.join(held, F.expr("source <=> held AND range = held_range"))
        .groupBy("source", "key", "id", "size", "before", "rest")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    order = Window.partitionBy("source").orderBy("key", "id", "size")
    places = places.withColumn("mass", F.col("size") * F.col("copies"))
    places = places.withColumn("start", F.col("before") + F.sum("mass").over(order) - F.col("mass"))
    at = places.where("start < rest AND start + mass >= rest").select(
        F.col("source").alias("at"),
        F.struct("key", "id", "size").alias("cut"),
        F.floor((F.col("rest") - F.col("start")) / F.col("copies")).cast("bigint").alias("part"),
    )
    return budgets.join(at, F.expr("source <=> at"), "left").select("source", "source_size", "target", "epochs", "cut", "part")


def taken(size: Column, key: Column, identity: Column) -> Column:
    """Words the mix takes of a document, given the columns of its source's cut."""
    place = F.struct(key.alias("key"), identity.alias("id"), size.alias("size"))
    at = place.eqNullSafe(F.col("cut"))
    extra = F.when(F.col("cut").isNull(), F.lit(0)).when(place < F.col("cut"), size).when(at, F.col("part")).otherwise(F.lit(0))
    return (F.col("epochs") * size + extra).cast("bigint")


def _decided(rows: DataFrame, cut: DataFrame, key: Column) -> DataFrame:
    """Rows with the cut of their source; a source's rows meet it in 16 places by their key's first digit."""
    digits = F.array(*[F.lit(f"{d:x}") for d in range(16)])
    spread = cut.withColumnRenamed("source", "cut_source").withColumn("cut_digit", F.explode(digits))
    return rows.withColumn("digit", F.substring(key, 1, 1)).join(spread, F.expr("digit = cut_digit AND source <=> cut_source"))


def mix(docs: DataFrame, identity: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(id, source, size, source_size, target, taken) of every document.

    NULL text has size 0; a NULL source is a source; a NULL id is a place like
    any other; repeated rows get the same answer; an empty table gives no rows.
    """
    sizes = common.stored(sized(docs, identity, source, text), "mixing-sizes")
    return _decided(sizes, common.stored(cuts(sizes, weights, share, most), "mixing-cuts", FILES), F.col("key")).select(
        F.col("id").alias(identity), "source", "size", "source_size", "target", taken(F.col("size"), F.col("key"), F.col("id")).alias("taken")
    )


def repeat(docs: DataFrame, identity: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of `docs`, once per whole epoch taken.

    A document taken in part comes with the first words of its text up to the
    cut, white space between them kept. Documents not taken go.
    """
    sizes = common.stored(sized(docs, identity, source, text), "mixing-sizes")
    # Written, so that Spark knows how small it is and leaves the texts where they are.
    decided = common.stored(cuts(sizes, weights, share, most), "mixing-cuts", FILES).select("source", "epochs", "cut", "part")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{source}`").alias("source"))
    size = word_count(F.col(f"doc.`{text}`"))
    joined = _decided(inner, decided, random_key(F.col(f"doc.`{identity}`"))).withColumn("size", size)
    counted = joined.withColumn("taken", taken(F.col("size"), random_key(F.col(f"doc.`{identity}`")), F.col(f"doc.`{identity}`")))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest("size", F.lit(1)))).otherwise(0).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(None).cast("int"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    epochs = counted.withColumn("words", F.explode(parts))
    pieces = F.regexp_extract_all(F.col(f"doc.`{text}`"), F.lit(r"[\x20\x09-\x0D]*" + common.WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words")), "")
    shown = {text: F.when(F.col("words").isNull(), F.col(f"doc.`{text}`")).otherwise(cut)}
    if "n_chars" in docs.columns:
        shown["n_chars"] = F.when(F.col("words").isNull(), F.col("doc.n_chars")).otherwise(F.length(cut))
    return epochs.select(*[shown.get(c, F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
