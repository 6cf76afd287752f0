from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tapeloom.llm import fingerprints as fp, textarrays as ta


def entropy_class(window):
    total = sum(int(round(c * np.log2(c) * 1024)) for c in Counter(window).values())
    return (64 * 6 * 1024 - total) >> 9


def brute_features(text, rank):
    """Hashes of the features of one text, window by window."""
    if not text:
        return []
    value = lambda a, b: int(ta.Hashes(ta.BYTE[np.frombuffer(text[a:b], np.uint8)]).of(np.array([0]), np.array([b - a]))[0])
    n = len(text) - 63
    if n <= 0:
        return [value(0, len(text))]
    ranks = [int(rank[entropy_class(text[i : i + 64])]) for i in range(n)]
    points = Counter(min(range(s, min(s + 64, n)), key=lambda i: (ranks[i], i)) for s in range(n))
    return list(dict.fromkeys(value(i, i + 64) for i in range(n) if points[i] >= min(16, n)))


def brute_counts(rows):
    count = np.zeros(fp.CLASSES, np.int64)
    for r in rows:
        text = (r[1] or "").encode()
        for i in range(len(text) - 63):
            count[entropy_class(text[i : i + 64])] += 1
    return count


@pytest.fixture(scope="module")
def short_rows(rows):
    """The same without the longest texts, which a test window by window would take long for."""
    return [r for r in rows if len(r[1] or "") < 1500]


def test_rarity_counts_every_window(spark, rows, docs, short_rows):
    few = spark.createDataFrame(short_rows, docs.schema)
    assert (fp.rarity(few) == fp.ranks(brute_counts(short_rows))).all()


def test_features_against_window_by_window(short_rows, monkeypatch):
    rank = fp.ranks(brute_counts(short_rows))
    texts = [(r[1] or "").encode() for r in short_rows]
    want = [fp.Chain(np.array(brute_features(t, rank), np.uint64)).text() for t in texts]
    for size in (fp.SLICE, 300, 100):
        # Long texts then go in parts.
        monkeypatch.setattr(fp, "SLICE", size)
        assert [c.text() for c in fp.chains(texts, rank)] == want


def test_query_against_brute_force(spark, docs, short_rows):
    df = spark.createDataFrame(short_rows, docs.schema).repartition(6)
    rank = fp.ranks(brute_counts(short_rows))
    key = {}
    for r in df.selectExpr("doc_id", "coalesce(text, '') text", "xxhash64(coalesce(text, '')) k").collect():
        key[r.doc_id, r.text] = r.k
    line = sorted(((r[0], r[1] or "") for r in short_rows), key=lambda r: (r[0] is None, -(r[0] or 0), key[r]))
    chain = {t: fp.Chain(np.array(brute_features(t.encode(), rank), np.uint64)) for _, t in line}
    want = []
    for i, (doc_id, text) in enumerate(line):
        after = line[(i + 1) % len(line)][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        other = fp.Chain(np.array(brute_features(edited.encode(), rank), np.uint64))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), chain[text].text(), other.text(), fp.likeness(chain[text], other), fp.likeness(chain[text], chain[after])))
    got = [tuple(r) for r in fp.fingerprint(df).collect()]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r))
    assert order(got) == order(want)


def test_long_texts_extra_columns_and_small_tables(spark, docs, crowded, empty):
    whole, again = (sorted(map(tuple, fp.fingerprint(d).collect()), key=str) for d in (docs, crowded))
    assert whole == again and len(whole) == docs.count()
    assert fp.fingerprint(empty).collect() == []
    one = fp.fingerprint(spark.createDataFrame([(7, "Only " * 50)], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 250
    same = fp.fingerprint(spark.createDataFrame([(None, None), (None, None), (None, "")], "doc_id long, text string")).collect()
    assert {(r.fingerprint, r.near_edited, r.near_next) for r in same} == {("0:", 1.0, 1.0)}


def test_likeness_is_bounded_symmetric_and_falls_with_the_share(rows):
    rng = random.Random(3)
    rank = fp.ranks(brute_counts(rows[:20]))
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    for n in (80, 400, 3000):
        text, other = make(n), make(n)
        cut = len(text)
        chain = fp.chains([(text[: int(cut * share)] + other[int(cut * share) :]).encode() for share in (1, 0.9, 0.67, 0.33, 0)], rank)
        near = [fp.likeness(chain[0], c) for c in chain]
        assert near == [fp.likeness(c, chain[0]) for c in chain]
        assert near[0] == 1 and near == sorted(near, reverse=True) and near[2] > 0.3 and near[4] < 0.1
        assert fp.likeness(chain[0], fp.parsed(chain[0].text())) == 1 and fp.parsed(chain[3].text()).text() == chain[3].text()
