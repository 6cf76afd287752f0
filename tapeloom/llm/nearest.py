"""Nearest neighbours by collision counting.

Vectors are projected on random lines. A query collides with a vector on a line if
the vector's projection lies in a window centred on the query's. Starting from a
narrow window the radius is grown step by step (virtual rehashing: the same sorted arrays, wider
windows), and a vector that collides on `threshold` of the lines is verified by
its true distance. A query is done at the radius R for which its k-th verified distance
is at most R, since vectors nearer than that have collided with high probability; so no
window ever grows beyond the k-th distance known.

Data vectors are dealt to blocks of bounded size by a hash of their id, each with its
own sorted arrays, one task's worth; queries meet every block in groups of bounded
size, and each (block, group) yields its k best, which Spark merges. That happens twice:
one narrow window in every block gives a query the k-th distance over all blocks, and
with that as its radius it goes to every block again, whose own k-th neighbour may be
far. The first radius is taken from a sample of distances between vectors, at most
`SAMPLE` of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from . import common

K = 10
LINES = 96
#: Collisions that make a candidate: 72 are expected at the radius, with a deviation of 4.2.
THRESHOLD = 66
#: Half a window, in radii: 3 in 4 lines separate vectors at distance R by less.
HALF_WIDTH = 1.15
GROWTH = 1.1
ROUNDS = 150
#: The first radius is so much smaller than the estimated distance of a k-th neighbour.
START = 1.2
BLOCK = 8192
GROUP = 8192
SAMPLE = 2000
SEED = 7


def usable(vectors: DataFrame, identity: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part: no NULL, no component that is NULL or not finite, not all zero."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(f"`{identity}`").isNotNull() & good).select(F.col(f"`{identity}`").alias("id"), v.cast("array<double>").alias("vector"))


def lines(dimensions: int, count: int = LINES, seed: int = SEED) -> np.ndarray:
    """Random directions, a column each, the same for every task."""
    return np.random.default_rng([seed, dimensions]).standard_normal((dimensions, count))


class Arrays:
    """Sorted projections of a block of vectors on every line."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, count: int):
        self.ids, self.vectors, self.squares = ids, vectors, (vectors**2).sum(axis=1)
        self.lines = lines(vectors.shape[1], count)
        # A row per line, so that a window is one stretch of memory.
        projected = np.ascontiguousarray((vectors @ self.lines).T)
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=1)
        self.order = order.astype(np.int32)
        #: Distances that were asked for, over all queries.
        self.verified = 0

    def verify(self, vector: np.ndarray, at: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k nearest of the candidates. A product of matrices leaves a few of them, whose distances are then taken exactly."""
        self.verified += len(at)
        square = float(vector @ vector)
        rough = self.squares[at] + square - 2 * (self.vectors[at] @ vector)
        if len(at) > k:
            slack = 1e-9 * (square + float(self.squares[at].max()))
            at = at[rough <= np.partition(rough, k - 1)[k - 1] + slack]
        found = np.sqrt(((self.vectors[at] - vector) ** 2).sum(axis=1))
        return sorted(zip(found.tolist(), self.ids[at].tolist(), strict=True))[:k]

    def search(self, query: int, vector: np.ndarray, radius: float, k: int, threshold: int, bound: float = math.inf, rounds: int = ROUNDS) -> list[tuple[float, int]]:
        """The k nearest found up to the distance `bound`, as (distance, id); fewer rounds than ROUNDS end the search early."""
        n, center = len(self.ids), vector @ self.lines
        # Projections of equal vectors may differ in their last bits.
        slack = 1e-9 * math.sqrt(float(vector @ vector))
        count = np.zeros(n, np.int64)
        low = high = None
        best: list[tuple[float, int]] = []
        done = np.zeros(n, bool)
        for _ in range(rounds):
            half = HALF_WIDTH * radius + slack
            begin = [int(row.searchsorted(c - half, "left")) for row, c in zip(self.sorted, center, strict=True)]
            end = [int(row.searchsorted(c + half, "right")) for row, c in zip(self.sorted, center, strict=True)]
            # Only what the wider window adds.
            parts = [(m, a, b) for m, (a, b) in enumerate(zip(begin, end, strict=True))]
            if low is not None:
                parts = [x for m, a, b in parts for x in ((m, a, low[m]), (m, high[m], b))]
            count += np.bincount(np.concatenate([self.order[m, a:b] for m, a, b in parts]), minlength=n)
            low, high = begin, end
            fresh = np.flatnonzero((count >= threshold) & ~done)
            done[fresh] = True
            fresh = fresh[self.ids[fresh] != query]
            if len(fresh):
                best = sorted([*best, *self.verify(vector, fresh, k)])[:k]
            reach = min(bound, best[-1][0]) if len(best) == k else bound
            if radius >= reach or done.all():
                break
            radius = min(radius * GROWTH, reach)
        else:
            rest = np.flatnonzero(~done & (self.ids != query))
            if rounds == ROUNDS and len(rest):
                best = sorted([*best, *self.verify(vector, rest, k)])[:k]
        return best


def first_radius(points: DataFrame, k: int, sample: int) -> float:
    """Near the distance of a k-th neighbour: between the first vectors by hash, extrapolated to all."""
    total = points.count()
    rows = points.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    vectors = np.array(max(by_size.values(), key=len)) if by_size else np.zeros((0, 1))
    if len(vectors) < 2:
        return 1.0
    squares = (vectors**2).sum(axis=1)
    gaps = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * vectors @ vectors.T, 0))
    np.fill_diagonal(gaps, np.inf)
    rank = min(len(vectors) - 2, max(0, math.ceil(k * len(vectors) / max(total, 1)) - 1))
    near = np.sort(gaps, axis=1)[:, rank]
    near = near[near > 0]
    return float(np.quantile(near, 0.25)) / START if len(near) else 1.0


_FOUND = "query_id long, `with` long, vec_id long, score double"


def _meet(points: DataFrame, queries: DataFrame, blocks: int, groups: int, radius: float, k: int, count: int, threshold: int, rounds: int) -> DataFrame:
    """(query_id, with, vec_id, score): what each block of (id, vector) finds for each of (id, vector, with, bound)."""
    kind = F.size("vector").alias("size")
    # Every vector is told its block by hash, so blocks are even; copies of one id spread by position.
    dealt = points.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        "block", "group", kind, F.lit(0).alias("asks"), F.col("id").cast("bigint").alias("id"), "vector", F.lit(0).cast("bigint").alias("with"), F.lit(0.0).alias("bound")
    )
    asking = queries.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int"))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "block", "group", kind, F.lit(1).alias("asks"), F.col("id").cast("bigint").alias("id"), "vector", "with", "bound"
    )

    def answer(arrays: Arrays | None, asked: list[tuple[int, int, np.ndarray, float]]) -> Iterator[tuple[int, int, int, float]]:
        for query, name, vector, bound in asked if arrays else ():
            # A known bound is the radius at which nothing more can be missed.
            first = bound if bound < math.inf else radius
            for score, other in arrays.search(query, vector, first, k, threshold, bound, rounds):
                yield query, name, other, score

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, vectors, arrays, asked, out = None, [], [], None, [], []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.float64())], names=["query_id", "with", "vec_id", "score"]
            )

        for batch in batches:
            one, two, three, asks, own, names, bounds = (batch.column(i).to_numpy() for i in (0, 1, 2, 3, 4, 6, 7))
            for i, vector in enumerate(batch.column(5).to_pylist()):
                here = (one[i], two[i], three[i])
                if here != last:
                    out += answer(arrays, asked)
                    last, ids, vectors, arrays, asked = here, [], [], None, []
                if asks[i]:
                    if arrays is None and ids:
                        arrays = Arrays(np.array(ids, np.int64), np.array(vectors), count)
                    asked.append((int(own[i]), int(names[i]), np.array(vector), float(bounds[i])))
                else:
                    ids.append(int(own[i]))
                    vectors.append(vector)
            if len(out) > 10000:
                yield table()
                out = []
        out += answer(arrays, asked)
        yield table()

    keys = ("block", "group", "size")
    return dealt.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys, "asks", "id").mapInArrow(task, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "with").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(points: DataFrame, queries: DataFrame, k: int = K, count: int = LINES, threshold: int = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, id, score): each query's k nearest found among the points but itself.

    For frames (id, vector). Vectors of different lengths never meet. Ties go to the
    smaller id; repeated rows are candidates each, those with the query's id none.
    Repeated queries are one. An id that asks with several vectors has the k nearest
    of each, ranked by vector. An empty table, or one without queries, gives no rows;
    other columns than (id, vector) take no part.
    """
    points, queries = common.stored(points, "nearest-points"), common.stored(queries.dropDuplicates(["id", "vector"]), "nearest-queries")
    radius = first_radius(points, k, sample)
    blocks = max(1, math.ceil(points.count() / BLOCK))
    groups = max(1, math.ceil(queries.count() / GROUP))
    told = queries.withColumn("with", F.xxhash64("vector"))
    probed = _best(_meet(points, told.withColumn("bound", F.lit(math.inf)), blocks, groups, radius, k, count, threshold, 1), k)
    bounds = probed.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "with", F.col("score").alias("bound"))
    bounded = told.join(bounds, ["id", "with"], "left").withColumn("bound", F.coalesce("bound", F.lit(math.inf)))
    known = common.stored(bounded.select("id", "vector", "with", "bound"), "nearest-bounds")
    found = _meet(points, known, blocks, groups, radius, k, count, threshold, ROUNDS)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
