import random

import pytest
from hypothesis import given, settings, strategies as st

from sample_times import BASE
from tapeloom.operators import asof, bars, divergence


def newest(left, right):
    out = []
    for row in left:
        key, at = row[0], row[1]
        found = [r for r in right if r[0] == key and r[1] is not None and key is not None and at is not None and r[1] <= at]
        out.append((*row, *(max(found, key=lambda r: r[1:])[1:] if found else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits, most", [(22, 1 << 20), (3, 1 << 20), (3, 5), (22, 7)])
def test_asof_against_all_pairs(spark, bits, most):
    rng = random.Random(bits * most)
    key = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    left = [(key(), rng.choice([None, rng.randrange(-40, 400)]), i) for i in range(300)] + [("a", 77, 900 + i) for i in range(60)]
    right = [(key(), rng.choice([None, rng.randrange(-60, 300)]), rng.choice([None, rng.randrange(5)])) for _ in range(60)]
    right = [r for r in right if r[0] != "c" or (r[1] or 0) > 100]
    rows = spark.createDataFrame(left, "k string, t bigint, n int").repartition(3)
    known = spark.createDataFrame(right, "k string, at bigint, v int").repartition(2)
    got = asof.join(rows, known, ["k"], "t", "at", chunk_bits=bits, most_rows=most).collect()
    assert sorted(map(tuple, got), key=str) == newest(left, right)


def test_asof_of_empty_frames_and_clashing_names(spark):
    left = spark.createDataFrame([("a", 5)], "k string, t bigint")
    none = spark.createDataFrame([], "k string, at bigint, v int")
    assert [tuple(r) for r in asof.join(left, none, ["k"], "t", "at").collect()] == [("a", 5, None, None)]
    assert asof.join(left.where("false"), none.unionByName(spark.createDataFrame([("a", 1, 1)], none.schema)), ["k"], "t", "at").collect() == []
    with pytest.raises(ValueError, match="both sides"):
        asof.join(left, left.withColumnRenamed("k", "k2"), ["k2"], "t", "t")


def test_a_trade_sees_the_bar_that_has_just_ended(trades_of):
    ticks = trades_of([(BASE + at, 100.0 + at / 1000, 1.0) for at in (0, 59_999, 60_000, 119_999, 500_000)])
    step = BASE - BASE % 60_000
    seen = asof.closed_features(ticks, bars.compute(ticks, "1min", (3,)), "1min").orderBy("ts").collect()
    assert [r.closed_at for r in seen] == [None if (r.ts // 60_000) * 60_000 <= step else (r.ts // 60_000) * 60_000 for r in seen]
    assert seen[-1].price_close == [r.price for r in seen if r.ts < seen[-1].closed_at][-1]
    with pytest.raises(ValueError, match="end with the day"):
        asof.closed_features(ticks, bars.compute(ticks, "7min", (3,)), "7min")


def brute_differences(left, right, width):
    """Surplus rows of each side, paired by key in order; only how many pairs and which columns could differ."""
    from collections import Counter

    a, b = Counter(left), Counter(right)
    off = {"left": a - b, "right": b - a}
    keys = {r[:width] for side in off.values() for r in side}
    changed = left_only = right_only = 0
    for k in keys:
        n, m = (sum(c for r, c in off[s].items() if r[:width] == k) for s in ("left", "right"))
        changed += min(n, m)
        left_only += max(0, n - m)
        right_only += max(0, m - n)
    return changed, left_only, right_only, len(left) - changed - left_only


values = st.sampled_from([None, 0.0, 1.5, float("inf")])
rows = st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "x", "y"]), values), max_size=25)


@given(rows, rows)
@settings(max_examples=8, deadline=None)
def test_divergence_counts(spark, left, right):
    schema = "id int, side string, value double"
    got = {r.subject: r.rows for r in divergence.report(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["id"]).collect()}
    changed, left_only, right_only, equal = brute_differences(left, right, 1)
    assert (got["changed"], got["left only"], got["right only"], got["equal"]) == (changed, left_only, right_only, equal)
    assert changed <= got["column: side"] + got["column: value"] <= 2 * changed


def test_planted_differences_are_found_all(spark):
    nan = float("nan")
    left = [(i, "s", float(i)) for i in range(500)] + [(1000, "hot", float(i % 7)) for i in range(400)] + [(2000, None, nan), (None, "n", None)]
    right = [r for r in left if r[0] != 17]
    right[3] = (3, "t", 3.0)
    right[4] = (4, "t", -1.0)
    right += [(5, "s", 5.0), (9999, "new", None), (1000, "hot", 50.0)]
    frames = [spark.createDataFrame(x, "id int, side string, value double").repartition(4) for x in (left, right)]
    found = divergence.differences(*frames, ["id"]).collect()
    told = sorted((r.id, r.status, tuple(r.differing)) for r in found)
    assert told == [(3, "changed", ("side",)), (4, "changed", ("side", "value")), (5, "right only", ()), (17, "left only", ()), (1000, "right only", ()), (9999, "right only", ())]
    assert divergence.differences(frames[0], frames[0], ["id"]).isEmpty()
    # More copies of a key on both sides than one stretch of hashes holds.
    one, other = (spark.range(3000).selectExpr("1 id", f"concat('{s}', id) side", "1.0 value") for s in "lr")
    assert divergence.differences(one, other.where("value > 0"), ["id"]).groupBy("status").count().collect()[0]["count"] == 3000
