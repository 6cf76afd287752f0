"""Reject documents whose statistics lie far from those of their kind.

For every (language, source) the minimum-covariance-determinant estimate of the
transformed statistics is found by concentration steps over all documents: take
the `SHARE` of them nearest to the present centre, estimate centre and
covariance from those alone, repeat. A document goes if its Mahalanobis
distance from its group's estimate exceeds a chi-square quantile.

Nothing of a group is ever gathered: a step is a histogram of distances with
fixed bins, the bin that holds the wanted share, and sums over the documents up
to that bin. Groups with few documents are estimated together, by language first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from . import common, statistics

#: Part of a group that an estimate rests on, so a quarter may be anything.
SHARE = 0.75
STEPS = 5
#: Chance that a document of a normal group is rejected.
ALPHA = 1e-6
#: Groups with fewer documents are judged with the other small groups of their language, and if those
#: are still fewer, with the small groups of all languages.
LEAST = 100
FEWEST_WORDS = 50
#: Files of tables that have a row per group.
FILES = 8

#: Transformed statistics: name, expression, least spread (standard deviation).
#: Most documents have no symbol, no repeated line and no repeated window, so
#: without a least spread the covariance would be singular and the first symbol
#: would condemn a text. Repetition gets a wide one, as up to half of the words
#: may repeat by the base rule.
FEATURES = (
    ("word_length", "ln(word_chars / greatest(n_words, 1) + 0.001)", 0.06),
    ("symbols", "n_symbols / (n_symbols + n_words + 1)", 0.02),
    ("lines", "n_dup_lines / (n_dup_lines + 0.1 * n_words + 1)", 0.1),
    ("repeats", "asin(sqrt(least(n_repeat_words / greatest(n_words, 1), 1.0)))", 0.2),
)
NAMES = tuple(name for name, _, _ in FEATURES)
SPREAD = np.array([s for _, _, s in FEATURES])
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
#: Bins of the logarithm of a squared distance: so many for each doubling.
BINS = 64
BASE_FAILED = f"n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > 50 * n_words"


def chi2_below(x: float, degrees: int) -> float:
    """The chi-square distribution function, by its power series."""
    a, term, total, k = degrees / 2, 1.0, 1.0, 0
    while term > 1e-17 * total:
        k += 1
        term *= (x / 2) / (a + k)
        total += term
    return total * math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1)) if x > 0 else 0.0


def chi2_point(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_below(middle, degrees) < p else (low, middle)
    return high


def measured(docs: DataFrame, text: str, keep: list[str], names: dict[str, str]) -> DataFrame:
    """The columns `keep` and the word statistics under the given names."""
    shown = list(dict.fromkeys([*keep, text]))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(names[n], T.LongType()) for n in statistics.NAMES])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics.measure(batch.column(shown.index(text)))
            columns = [batch.column(shown.index(c)) for c in keep] + [pa.array(found[n], pa.int64()) for n in statistics.NAMES]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(names[n] for n in statistics.NAMES)])

    return docs.select(*[F.col(f"`{c}`") for c in shown]).mapInArrow(task, schema)


def _features(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.expr(rule) for name, rule, _ in FEATURES})


def _group(lang: str, source: str) -> Column:
    """Text that tells NULL from empty."""
    return F.to_json(F.struct(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source")))


def _distance() -> Column:
    """Squared Mahalanobis distance, given the columns `center` and `precision`."""
    off = [F.col(n) - F.col("center")[i] for i, n in enumerate(NAMES)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + off[i] * off[j] * F.col("precision")[k] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _bin(squared: Column) -> Column:
    return F.floor(F.log2(squared + 1e-9) * BINS).cast("int")


def _upto(counts: DataFrame, bin_name: str, share: float) -> DataFrame:
    """For each group the first bin up to which the share of its rows lies."""
    order = Window.partitionBy("kind").orderBy(bin_name)
    whole = Window.partitionBy("kind")
    sums = counts.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(whole))
    return sums.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy("kind").agg(F.min(bin_name).alias("edge"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians on a grid of 1/1000, and the least spreads."""
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.floor(F.col(n) * 1000).cast("int").alias("cell")) for i, n in enumerate(NAMES)]))
    cells = rows.select("kind", grid.alias("c")).groupBy("kind", "c.at", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("kind", "at").orderBy("cell")
    sums = cells.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("kind", "at")))
    medians = sums.where("2 * upto >= all").groupBy("kind", "at").agg(F.min("cell").alias("cell"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "cell"))), lambda x: (x["cell"] + 0.5) / 1000)
    precision = F.array(*[F.lit(float(1 / SPREAD[i] ** 2) if i == j else 0.0) for i, j in PAIRS])
    return medians.groupBy("kind").agg(ordered.alias("center")).withColumn("precision", precision)


def _estimate(sums: DataFrame, share: float) -> DataFrame:
    p = len(NAMES)
    # The nearest part of a normal sample spreads less than the whole.
    swell = share / chi2_below(chi2_point(share, p), p + 2) if share < 1 else 1.0

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                mean = np.array(row.first) / row.n
                covariance = np.zeros((p, p))
                for k, (i, j) in enumerate(PAIRS):
                    covariance[i, j] = covariance[j, i] = row.second[k] / row.n - mean[i] * mean[j]
                precision = np.linalg.inv(covariance * swell + np.diag(SPREAD**2))
                rows.append((row.kind, mean, np.array([precision[i, j] for i, j in PAIRS])))
            yield pd.DataFrame(rows, columns=["kind", "center", "precision"])

    return sums.mapInPandas(task, "kind string, center array<double>, precision array<double>")


def estimate(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """(kind, center, precision) for rows (kind, the features)."""
    found = common.stored(_start(rows), "outliers-start", FILES)
    for _ in range(steps):
        placed = rows.join(found, "kind").withColumn("bin", _bin(_distance()))
        counts = placed.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"))
        near = placed.join(common.stored(_upto(counts, "bin", share), "outliers-edges", FILES), "kind").where("bin <= edge")
        sums = near.groupBy("kind").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(n) for n in NAMES]).alias("first"),
            F.array(*[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i, j in PAIRS]).alias("second"),
        )
        found = common.stored(_estimate(sums, share), "outliers-step", FILES)
    return found


def _kinds(sound: DataFrame, least: int) -> DataFrame:
    """(own, kind): the group that each own group is judged with."""
    sizes = sound.groupBy("own").agg(F.count(F.lit(1)).alias("n"))
    # A name that no own group has: NULL languages are a language.
    pool = F.to_json(F.struct(F.get_json_object("own", "$.lang").alias("lang"), F.lit(True).alias("pooled")))
    named = sizes.withColumn("pool", pool)
    pools = named.where(F.col("n") < least).groupBy("pool").agg(F.sum("n").alias("in_pool"))
    kind = F.when(F.col("n") >= least, F.col("own")).when(F.col("in_pool") >= least, F.col("pool")).otherwise("")
    return named.join(pools, "pool", "left").select("own", kind.alias("kind"))


def fit(stats: DataFrame, share: float = SHARE, steps: int = STEPS, least: int = LEAST) -> DataFrame:
    """(own, center, precision) for every group of rows that pass the base rule."""
    sound = _features(stats.where(f"NOT ({BASE_FAILED})")).select("own", *NAMES)
    kinds = common.stored(_kinds(sound, least), "outliers-kinds", FILES)
    rows = sound.join(kinds, "own").select("kind", *NAMES)
    return common.stored(kinds.join(estimate(rows, share, steps), "kind").select("own", "center", "precision"), "outliers", FILES)


def verdict(stats: DataFrame, model: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The rows with base_failed, distance and kept."""
    point = chi2_point(1 - alpha, len(NAMES))
    joined = _features(stats).join(model, "own", "left")
    failed = F.expr(BASE_FAILED)
    distance = F.when(~failed, F.sqrt(_distance()))
    return joined.withColumns(
        {"base_failed": failed, "distance": distance, "kept": ~failed & F.coalesce(distance * distance <= point, F.lit(True))}
    ).drop(*NAMES, "center", "precision")


def judge(docs: DataFrame, identity: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text", **options) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) per document.

    NULL and empty texts have no word and fail the base rule, as do texts under
    50 words and texts half of whose words repeat; these have no distance and
    no say in the estimates. Groups under `least` documents share an estimate with the
    small groups of their language, then of all languages. NULL languages and sources are groups of their
    own. Repeated rows count each. An empty table gives no rows.
    """
    alpha = options.pop("alpha", ALPHA)
    columns = docs.select(F.col(f"`{identity}`").alias("id"), _group(lang, source).alias("own"), F.col(f"`{text}`").alias("text"))
    stats = common.stored(measured(columns, "text", ["id", "own"], {n: n for n in statistics.NAMES}), "outliers-statistics")
    judged = verdict(stats, fit(stats, **options), alpha)
    return judged.select(F.col("id").alias(identity), *statistics.NAMES, "base_failed", "distance", "kept")


def keep(docs: DataFrame, identity: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns, by the rules of `judge`.

    NULL and empty texts go. Repeated rows stay or go together. An empty table gives no rows.
    """
    alpha = options.pop("alpha", ALPHA)
    (whole,) = common.fresh(docs, "document")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), _group(lang, source).alias("own"), F.col(f"`{text}`").alias("text")
    )
    same = {n: n for n in statistics.NAMES}
    model = fit(common.stored(measured(packed, "text", ["own"], same), "outliers-statistics"), **options)
    return verdict(measured(packed, "text", [whole, "own"], same), model, alpha).where("kept").select(f"{whole}.*")
