from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from tapeloom.llm import merkle, ranking

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS)


def reduced(nodes):
    """(root, path of each leaf: per level the siblings before and after it)."""
    level, paths, own = list(nodes), [[] for _ in nodes], list(range(len(nodes)))
    while len(level) > 1:
        for i, at in enumerate(own):
            begin = at - at % 16
            paths[i].append((level[begin:at], level[at + 1 : begin + 16]))
            own[i] = at // 16
        level = [H(level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    ordered, trees = sorted(groups, key=lambda s: (s is not None, (s or "").encode())), {}
    for name in ordered:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = reduced([leaf(r) for r in groups[name]])
    root, tops = reduced([trees[n][0] for n in ordered])
    out = []
    for name, top in zip(ordered, tops, strict=True):
        for row, path in zip(groups[name], trees[name][1], strict=True):
            now = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
                now["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            end, proof = leaf(now), []
            for before, after in [*path, *top]:
                end = H([*before, end, *after])
                proof += [*before, *after]
            out.append((row["doc_id"], leaf(row), trees[name][0], root, H(proof), end, end == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


@pytest.fixture(scope="module")
def wide(spark):
    """A source of more leaves than two builders take, one of one leaf, and more sources than one run."""
    rows = [(i, f"Text Of {i}", "en", "big", i) for i in range(3 * 4096 + 1)]
    rows += [(50000 + i, None if i % 3 else "é Ä B", None, f"s{i:02d}", None) for i in range(40)]
    rows += [(60000 + i, "Same", "de", None, 4) for i in range(17)] + [(60000, "Same", "de", None, 4)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def test_manifest_against_plain_reduction(docs, crowded, wide):
    for df in (docs, wide):
        assert ordered(merkle.verify(df).collect()) == ordered(brute([r.asDict() for r in df.collect()]))
    assert ordered(merkle.verify(crowded).collect()) == ordered(merkle.verify(docs).collect())


def test_a_table_without_rows(empty):
    assert merkle.verify(empty).collect() == []


def test_the_log_is_in_order_of_completion(spark, wide):
    rows = wide.selectExpr("source tree", "doc_id id", "unhex(sha2(text, 256)) digest", "cast(null as binary) changed").fillna("", ["tree"]).where("digest is not null")
    groups, top = merkle.manifest(rows)
    assert len(groups) == 2 and len(top) == 1
    by_tree = {}
    for r in merkle.nodes(groups).collect():
        by_tree.setdefault(r["tree"], []).append(r)
    for nodes in by_tree.values():
        nodes.sort(key=lambda r: r["position"])
        assert [r["position"] for r in nodes] == list(range(len(nodes)))
        covered, open_ = 0, {}
        for r in nodes:
            if r["level"] == 0:
                assert r["index"] == covered
                covered += 1
            else:
                children = open_.pop(r["level"] - 1)
                assert bytes.fromhex(H(c.hex() for c in children)) == bytes(r["digest"])
            open_.setdefault(r["level"], []).append(bytes(r["digest"]))
        assert len(open_) == 1 and len(next(iter(open_.values()))) == 1


@given(st.integers(1, 5000))
@settings(max_examples=60, deadline=None)
def test_positions_have_no_gaps(n):
    found, count, level = [], n, 0
    while True:
        found += [int(merkle.position(level, i, n)) for i in range(count)]
        if count == 1:
            break
        count, level = -(-count // 16), level + 1
    assert sorted(found) == list(range(len(found))) and level == merkle.height(n)


def test_places_within_a_hot_key(spark):
    rows = [(("a", None, "b")[0 if i % 10 else i // 10 % 3], i * 7 % 400 // 2) for i in range(2000)] + [("a", 5)] * 500
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    found = ranking.ranked(df, "k", ["v"], "n").collect()
    for key in ("a", None, "b"):
        own = sorted((r.n, r.v) for r in found if r.k == key)
        assert [n for n, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for k, v in rows if k == key)
