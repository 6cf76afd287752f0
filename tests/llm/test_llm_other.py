from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import nearest, sharding


# --- nearest neighbours ----------------------------------------------------------------


def vectors(seed=3, n=900, size=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, size))
    return [(i, (centers[rng.integers(12)] + 0.3 * rng.normal(size=size)).astype(float).tolist()) for i in range(n)]


AWKWARD = [
    (900, None), (1000, [0.0] * 16), (1100, [float("nan")] * 16), (1200, [1.0, None] + [1.0] * 14), (1300, [float("inf")] * 16), (1400, []),
    (1500, [1.0, 2.0]), (None, [1.0] * 16), (1600, [5.0] * 16), (1700, [5.0] * 16), (1701, [5.0] * 16),
]


@pytest.fixture(scope="module")
def space(spark):
    rows = vectors() + AWKWARD
    rows.append(rows[100])
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def exact(rows, query, own, k=10):
    kept = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    found = sorted((float(np.sqrt(((np.array(v) - np.array(own)) ** 2).sum())), i) for i, v in kept if len(v) == len(own) and i != query)
    return found[:k]


def test_few_vectors_are_verified():
    """Vectors without clusters, all about as far from each other: the hardest case."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(4096, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    block, hits, queries = nearest.Arrays(np.arange(len(rows)), rows, nearest.LINES), 0, range(0, 4096, 128)
    for query in queries:
        away = np.linalg.norm(rows - rows[query], axis=1)
        want = set(np.argsort(away)[1:11].tolist())
        hits += len(want & {i for _, i in block.search(query, rows[query], 0.9, 10, nearest.THRESHOLD)})
    assert hits >= 0.95 * 10 * len(queries)
    assert block.verified < len(rows) * len(queries) / 3


def test_no_radius_for_copies():
    """A bound of 0 finds all copies, although their projections may differ in the last bits."""
    rows = np.concatenate([np.repeat(np.full((1, 16), 0.1), 30, axis=0), np.random.default_rng(1).normal(size=(50, 16))])
    block = nearest.Arrays(np.arange(80), rows, nearest.LINES)
    assert block.search(7, rows[7], 0.0, 10, nearest.THRESHOLD, 0.0) == [(0.0, i) for i in range(11) if i != 7]


def test_blocks_share_a_bound(space, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 100)
    test_recall_and_scores(space)


def test_nobody_asks_and_clashing_columns(space, spark):
    rows, df = space
    points = nearest.usable(df, "vec_id", "embedding")
    assert nearest.search(points, points.where("id < 0")).collect() == []
    assert nearest.search(points.where("id < 0"), points.where("id < 0")).collect() == []
    more = df.selectExpr("vec_id", "embedding", "1 AS id", "'x' AS vector", "2 AS bound", "3 AS `with`", "4 AS block")
    assert nearest.usable(more, "vec_id", "embedding").columns == ["id", "vector"]
    assert sorted(map(str, nearest.usable(more, "vec_id", "embedding").collect())) == sorted(map(str, points.collect()))


def test_recall_and_scores(space):
    rows, df = space
    points = nearest.usable(df, "vec_id", "embedding")
    found = defaultdict(list)
    for r in nearest.search(points, points.where("id % 100 = 0")).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    by_id = {i: v for i, v in rows if i is not None}
    hits = total = 0
    assert set(found) == {*range(0, 900, 100), 1600, 1700}
    for query, own in found.items():
        want = exact(rows, query, by_id[query])
        assert own == sorted(own)
        for score, other in own:
            assert other != query
            assert abs(score - np.linalg.norm(np.array(by_id[other]) - np.array(by_id[query]))) < 1e-12
        hits += len({i for _, i in own} & {i for _, i in want})
        total += len({i for _, i in want})
    assert hits >= 0.9 * total


def test_repeated_queries_lose_nothing(spark):
    rows = vectors(n=300)
    other = rows[200][1]
    rows += [rows[100], rows[100], (200, [-x for x in other]), (250, rows[250][1])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    found = defaultdict(list)
    for r in nearest.search(df, df.where("id IN (0, 100, 200, 250)"), threshold=0).collect():
        found[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    for query, own in ((0, [rows[0][1]]), (100, [rows[100][1]]), (200, [other, [-x for x in other]]), (250, [rows[250][1]])):
        want = [(rank, i, round(score, 9)) for v in own for rank, (score, i) in enumerate(exact(rows, query, v), 1)]
        assert sorted(found[query]) == sorted(want), query


def test_fewer_vectors_than_wanted(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0]), (200, [1.0, 2.0, 3.0])], "id long, vector array<double>")
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in nearest.search(df, df.where("id % 100 = 0")).collect()}
    assert found == {(0, 1): (100, 1.0), (0, 2): (1, 2**0.5), (100, 1): (0, 1.0), (100, 2): (1, 1.0)}
    empty = df.where("id < 0")
    assert nearest.search(empty, empty).collect() == []


def test_blocks_and_groups_give_the_same(space, monkeypatch):
    _, df = space
    points = nearest.usable(df, "vec_id", "embedding")
    asked = points.where("id % 100 = 0")
    nearest_two = lambda: {(r.query_id, r.rank): r.vec_id for r in nearest.search(points, asked, k=2, threshold=0).collect()}
    whole = nearest_two()
    monkeypatch.setattr(nearest, "BLOCK", 64)
    monkeypatch.setattr(nearest, "GROUP", 3)
    assert nearest_two() == whole


# --- shards -----------------------------------------------------------------------------


def shards(rows, limit):
    keys = [int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16) for r in rows]
    sizes = [len((r[1] or "").encode()) for r in rows]
    out = {}

    def split(members, depth):
        if sum(sizes[m] for m in members) <= limit or len(members) == 1:
            for m in members:
                out[m] = (rows[m][0], sizes[m], (1 << depth) + (keys[m] >> (60 - depth)), 0, depth, sum(sizes[x] for x in members))
            return
        for bit in (0, 1):
            half = [m for m in members if (keys[m] >> (59 - depth)) & 1 == bit]
            if half:
                split(half, depth + 1)

    split(list(range(len(rows))), 0)
    return sorted(out.values())


@pytest.mark.parametrize("limit", [1, 3000, 40_000, 1 << 30])
def test_shards_are_shortest_fitting_prefixes(spark, docs, rows, limit):
    once = list({r[0]: r for r in rows if r[0] is not None}.values())
    found = sharding.assign(spark.createDataFrame(once, docs.schema), limit=limit)
    assert sorted(map(tuple, found.collect())) == shards(once, limit)


@pytest.mark.parametrize("bits", [4, 15])
def test_repeated_rows_spread_over_shards(spark, docs, bits, monkeypatch):
    monkeypatch.setattr(sharding, "BITS", bits)
    rows = [(7, "x" * 100, "en", "s", 100)] * 60 + [(i, "y" * 10, "en", "s", 10) for i in range(20)] + [(99, "z" * 5000, "en", "s", 5000)] * 2 + [(None, None, None, None, None)] * 3
    found = sharding.assign(spark.createDataFrame(rows, docs.schema).repartition(3), limit=1000).collect()
    assert len(found) == len(rows)
    sizes, members = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.shard_id, r.overflow] += r.bytes
        members[r.shard_id, r.overflow] += 1
    assert all(size <= 1000 or members[s] == 1 for s, size in sizes.items())
    assert all(r.shard_bytes == sizes[r.shard_id, r.overflow] for r in found)


def test_shard_edges(empty, crowded, docs):
    assert sharding.assign(empty).collect() == []
    plain = lambda df: sorted(str(tuple(r)) for r in sharding.assign(df.where(F.col("doc_id") > 10), limit=30_000).collect())
    assert plain(crowded) == plain(docs)
