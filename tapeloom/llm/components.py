"""Connected components of a graph given by its links, as rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Links from neighbours of each node to its least one.

    Large star: from the larger neighbours. Small star: from the smaller ones and
    the node itself. Neither parts or joins components.
    """
    if larger:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = both.join(least, "a")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def _local(links: DataFrame) -> DataFrame:
    """Each partition's links as stars, by union and find over its own links; no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        kinds = None

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            kinds = batch.schema
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
        if kinds is not None:
            found = [(x, r) for x in list(parent) if (r := root(x)) != x]
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], names=["a", "b"])

    return links.mapInArrow(task, links.schema)


#: Links that one task joins at once, some hundred bytes each.
TASK_LINKS = 1 << 18


def _labels(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component) for links (a, b): the least node reachable from each linked node.

    First each partition's links become stars of their own. Then large and small
    stars in turn, until every node hangs on the least one of its component or one
    task can hold what is left; the rounds grow with the logarithm of the longest path.
    A node with many links is a key of a join with one row per node, which Spark splits.
    """
    links = common.stored(_local(links.where("a <> b").select("a", "b")), "links-local")
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return _labels(links)
        if state[0] <= task_links:
            return _labels(common.stored(_local(links.coalesce(1)), "links"))
        seen = state
        links = common.stored(_stars(_stars(links, True), False), "links")
