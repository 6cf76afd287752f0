from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from tapeloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    """(id, size, source_size, target, taken) of every row, by plain loops."""
    docs = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows]
    sizes = Counter()
    for _, source, size in docs:
        sizes[source] += size
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    places = defaultdict(Counter)
    for i, source, size in docs:
        key = hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
        places[source][(key, -math.inf if i is None else i, size)] += 1
    out, extra = [], {}
    for source, own in places.items():
        budget = math.floor(target[source] + 0.5)
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        at = 0
        for (key, i, size), copies in sorted(own.items()):
            extra[source, i, size] = epochs * size + min(size, max(0, rest - at) // copies)
            at += size * copies
    for i, source, size in docs:
        out.append((i, size, sizes[source], round(target[source], 6), extra[source, -math.inf if i is None else i, size]))
    return out


def got(df):
    return [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect()]


def order(found):
    return sorted(found, key=lambda r: (r[0] is None, r))


def test_equals_plain_loops(docs, rows):
    found = got(mixing.mix(docs))
    assert order(found) == order(expected(rows))
    assert order(got(mixing.mix(docs.repartition(2)))) == order(found)


def test_budgets_are_met(docs):
    rows = mixing.mix(docs).collect()
    assert all(r.taken <= 2 * r.size for r in rows)
    by_source = defaultdict(int)
    for r in rows:
        by_source[r.source, r.target] += r.taken
    # Repeated rows at a cut share evenly, rounded down.
    assert all(abs(taken - target) <= 4 for (_, target), taken in by_source.items())


@pytest.mark.parametrize("few", [[(1, None, "en", None, 0)], [(1, "a b c", "en", "s", 0)] * 7, [(1, "a", "en", "s", 0), (2, "", "en", "t", 0)]])
def test_small_tables(spark, docs, few):
    df = spark.createDataFrame(few, docs.schema)
    assert order(got(mixing.mix(df))) == order(expected(few))


def test_empty_and_crowded(empty, crowded, docs):
    assert mixing.mix(empty).collect() == [] and mixing.repeat(empty).collect() == []
    assert order(got(mixing.mix(crowded))) == order(got(mixing.mix(docs)))
    assert mixing.repeat(crowded).columns == crowded.columns


def test_repeat_takes_as_many_words(docs):
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        wanted[r.doc_id] += r.taken
    found = Counter()
    for r in mixing.repeat(docs).collect():
        assert r.text is None or len(WORD.findall(r.text)) > 0
        assert r.n_chars == len(r.text) or r.doc_id is None
        found[r.doc_id] += len(WORD.findall(r.text))
    assert +found == +wanted
