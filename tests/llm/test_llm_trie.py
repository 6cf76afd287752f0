from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tapeloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in own.items()}
    members = {}
    ends, children = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(first, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
        ends.setdefault(path, []).append(c)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, ())
        leaves[path] = sum(leaves[b] for b in below) or 1
        words = len(WORD.findall(path[-1][1])) if path else 0
        saved[path] = sum(saved[b] for b in below) + (len(members[path]) - 1) * words
    out = []
    for path, own_ in members.items():
        text = ",".join(map(str, sorted(ends.get(path, []))))
        out.append((min(own_), len(path), min(members[path[:-1]]) if path else None, len(own_), len(children.get(path, ())), leaves[path], saved[path], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def conversations(seed, n=90):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-40, 400), n):
        longest = rng.choice([1, 2, 3, 5, 9])
        for turn in range(longest):
            rows.append((c, turn, rng.choice(["user", None]), rng.choice(["hi there", "hi there you", "", None, "a b c"])))
    for c in range(500, 540):  # copies, and copies that go on
        rows += [(c, t, "user", f"turn number {t}") for t in range(12 if c % 3 else 12 + c % 7)]
    rows += [(0, None, "user", "first of all"), (1, 3, None, None), (1, 3, None, None), (1, 3, "user", "tie"), (None, 0, "user", "nobody's")]
    rows += [(c, t, "r", f"{'deep ' * (t % 3)}{t}") for c in (601, 602, 603) for t in range(70 if c != 603 else 66)]
    rows += [(700, 0, "a", "word " * 3000), (701, 0, "a", "word " * 3000)]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = conversations(4)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("width, size", [(64, 4096), (2, 7), (3, 1), (5, 2)])
def test_nodes_against_brute_force(talks, width, size):
    rows, df = talks
    # Narrow panels and short slices, so that nodes cross both.
    assert sorted(map(tuple, trie.nodes(df, width=width, slice_rows=size).collect()), key=lambda r: r[:2]) == sorted(brute(rows), key=lambda r: r[:2])


def test_a_group_of_copies_that_fills_many_slices(spark):
    rows = [(20 * c, t, "user", f"same {t}") for c in range(1500) for t in range(3 + (c % 50 == 0))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert sorted(map(tuple, trie.nodes(df, slice_rows=64).collect()), key=lambda r: r[:2]) == sorted(brute(rows), key=lambda r: r[:2])


def test_empty_tables_turnless_conversations_and_extra_columns(spark, talks):
    assert trie.nodes(spark.createDataFrame([], SCHEMA)).collect() == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    alone = trie.nodes(spark.createDataFrame([(c, 0, "user", "gone")], SCHEMA)).collect()
    assert [tuple(r) for r in alone] == brute([(c, 0, "user", "gone")]) and alone[0].depth == 0 and alone[0].n_leaves == 1
    from pyspark.sql import functions as F

    rows, df = talks
    more = df.select("*", *[F.lit(1).alias(x) for x in ("at", "conv", "name", "words", "part", "PANEL", "kind", "ids", "depth")])
    assert sorted(map(tuple, trie.nodes(more).collect()), key=lambda r: r[:2]) == sorted(brute(rows), key=lambda r: r[:2])
