from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brute_links import linked
from tapeloom.llm import anchors, components, jaccard, repeats, textarrays as ta, window_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def windows_removed(rows, window=35):
    words = [WORD.findall(r[1] or "") for r in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = b"\1" * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def bytes_removed(rows, length=400):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(hash(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        steps = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[hash(t[i : i + length])] > 1:
                steps[i] += 1
                steps[i + length] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) > 0))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((r[0], len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


# --- arrays -----------------------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c\x85", max_size=30)), max_size=12))
@settings(max_examples=150, deadline=None)
def test_words_of_batches(texts):
    data, offsets = ta.flat(pa.array(texts, pa.string()))
    words = ta.Words(data, offsets)
    got = [[data[words.start[k] : words.end[k]].tobytes().decode() for k in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]


@given(st.lists(st.integers(0, 2), min_size=0, max_size=200), st.integers(2, 9), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_every_window_has_one_context(symbols, window, gram):
    gram = min(gram, window)
    values = ta.values(3, 9)[np.array(symbols, int)]
    bounds = np.array([0, len(symbols) // 3, len(symbols)])
    seen, anchor_of = [], {}
    for found in anchors.find(values, bounds, window, gram):
        for t, at, a, b, x, c in zip(found.text, found.at, found.first, found.last, found.anchor, found.context, strict=True):
            for i in range(a, b + 1):
                assert i <= at <= i + window - gram
                seen.append((t, i))
                content = tuple(symbols[bounds[t] + i : bounds[t] + i + window])
                assert anchor_of.setdefault(content, (x, at - i)) == (x, at - i)
            del c
    assert sorted(seen) == [(t, i) for t in (0, 1) for i in range(bounds[t + 1] - bounds[t] - window + 1)]


def test_long_texts_go_in_pieces(monkeypatch):
    values = ta.values(50, 3)[np.random.default_rng(1).integers(0, 50, 5000)]
    whole = {}
    for limit in (1 << 21, 700):
        monkeypatch.setattr(anchors, "SLICE", limit)
        cover = []
        for found in anchors.find(values, np.array([0, 5000]), 35, 8):
            for at, a, b in zip(found.at, found.first, found.last, strict=True):
                cover += [(i, at) for i in range(a, b + 1)]
        whole[limit] = sorted(cover)
    assert whole[700] == whole[1 << 21] and len(whole[700]) == 5000 - 34


@given(st.lists(st.binary(max_size=6), min_size=2, max_size=9), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_classes_hold_all_pairs(sides, wanted):
    entries = sorted({(s[: len(s) // 2], s[len(s) // 2 :]) for s in sides}, key=lambda e: (e[1], e[0]))
    lefts, rights = [e[0] for e in entries], [e[1] for e in entries]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    best = defaultdict(lambda: (0, 0))
    for i in range(len(entries)):
        for j in range(len(entries)):
            x, y = shared(lefts[i], lefts[j]), shared(rights[i], rights[j])
            if i != j and x + y >= wanted:
                best[i] = (max(best[i][0], x), max(best[i][1], y))
    found = defaultdict(lambda: (0, 0))
    for right, left, members, ahead in repeats.classes(lefts, rights, wanted):
        assert len(members) > 1 and left + right >= wanted and min(ahead) >= left
        for m, a in zip(members, ahead, strict=True):
            found[m] = (max(found[m][0], a), max(found[m][1], right))
    assert {k: v for k, v in found.items()} == dict(best)


@given(st.lists(st.binary(max_size=6), min_size=2, max_size=9), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_maximal_repeats_are_all_found(sides, wanted):
    halves = sorted({(bytes(x % 2 for x in s[: len(s) // 2]), bytes(x % 2 for x in s[len(s) // 2 :])) for s in sides}, key=lambda e: (e[1], e[0]))
    lefts, rights = [e[0] for e in halves], [e[1] for e in halves]
    best = set()
    for x in {a[:n] for a in lefts for n in range(len(a) + 1)}:
        for y in {b[:n] for b in rights for n in range(len(b) + 1)}:
            members = [i for i, (a, b) in enumerate(halves) if a.startswith(x) and b.startswith(y)]
            before, after = ([e[k][len(z) :][:1] for i in members for e in [halves[i]]] for k, z in ((0, x), (1, y)))
            if len(members) > 1 and len(x) + len(y) >= wanted and all(b"" in c or len(set(c)) > 1 for c in (before, after)):
                best.add((len(y), len(x), tuple(members)))
    found = [(right, left, tuple(sorted(members))) for right, left, members in repeats.maximal(lefts, rights, wanted)]
    assert sorted(found) == sorted(best)


# --- operators ----------------------------------------------------------------------


def test_word_windows(docs, rows):
    found = [tuple(r) for r in window_dedup.kept_words(docs).collect()]
    assert order(found) == order(windows_removed(rows))


def test_sketch_loses_nothing_when_full(docs, rows):
    spans = window_dedup.repeated_spans(anchors.identified(docs, "doc_id", "text"), width=window_dedup.BLOCK)
    wide = window_dedup.repeated_spans(anchors.identified(docs, "doc_id", "text"))
    as_rows = lambda df: sorted((str(r.id), r.key, sorted(map(tuple, r.spans or []))) for r in df.collect())
    assert as_rows(spans) == as_rows(wide)


def test_merged_sketch_never_undercounts(docs):
    rows = anchors.identified(docs, "doc_id", "text")
    test = window_dedup.repeated_anchors(rows)()
    counts = {r["anchor"]: r["n"] for r in anchors.rows(rows, window_dedup.UNIT).groupBy("anchor").agg({"*": "count"}).toDF("anchor", "n").collect()}
    keys = np.array(list(counts), np.int64).view(np.uint64)
    flagged = test(keys)
    assert all(f for f, n in zip(flagged, counts.values(), strict=True) if n > 1)
    assert sum(flagged) < len(keys)


@pytest.mark.parametrize("most", [repeats.MOST_VARIANTS, 1, 3])
def test_byte_strings(docs, rows, most, monkeypatch):
    monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (repeats.UNIT, most))
    found = [tuple(r) for r in repeats.kept_bytes(docs).collect()]
    assert order(found) == order(bytes_removed(rows))


def _nested_repeats():
    """Variants of a passage that part at different places on both sides, with exact copies."""
    draw = random.Random(5)
    filler = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    passage, out = filler(700), []
    for cut in (0, 0, 40, 40, 90, 150, 150, 200):
        for end in (700, 650, 600):
            out.append(filler(300) + passage[cut:end] + filler(300))
    return [(i, t) for i, t in enumerate(out + out[:2] + [None, ""])]


def test_groups_of_crowded_anchors(spark):
    rows = _nested_repeats()
    nested = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def groups(most):
        out = defaultdict(set)
        for r in repeats.maximal_repeats(nested, most=most).collect():
            out[r.anchor, r.repeat].add((r.doc_id, r.start, r.length))
        return out

    texts = {i: (t or "").encode() for i, t in rows}
    wanted = groups(repeats.MOST_VARIANTS)
    for members in wanted.values():
        assert len(members) > 1
        assert len({texts[i][start : start + length] for i, start, length in members}) == 1
        assert all(length >= 400 for _, _, length in members)
        assert len({length for _, _, length in members}) == 1
    seen = sorted(sorted(g) for g in wanted.values())
    assert max(map(len, seen)) > 10
    for most in (1, 5):
        assert sorted(sorted(g) for g in groups(most).values()) == seen
    # Every string of 400 bytes that occurs twice lies in a group, with all its occurrences.
    where = defaultdict(set)
    for i, t in texts.items():
        for at in range(len(t) - 399):
            where[t[at : at + 400]].add((i, at))
    covers = [{(i, start): length for i, start, length in g} for g in wanted.values()]
    for places in (p for p in where.values() if len(p) > 1):
        i, at = min(places)
        assert any(
            all((j, start + b - at) in cover for j, b in places)
            for cover in covers
            for (k, start), length in cover.items()
            if k == i and start <= at and at + 400 <= start + length
        )


def test_maximal_repeats_are_repeats(docs, rows):
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add((r[1] or "").encode())
    groups = defaultdict(list)
    for r in repeats.maximal_repeats(docs).collect():
        groups[r.anchor, r.repeat].append(r)
    assert groups
    for members in groups.values():
        assert len(members) > 1 and all(m.length >= 400 for m in members)
        assert len({m.length for m in members}) == 1
        assert len({t[m.start : m.start + m.length] for m in members for t in texts[m.doc_id] if len(t) >= m.start + m.length}) == 1


@pytest.mark.parametrize("percent", [90, 80])
def test_shingle_links(docs, rows, percent):
    found = [tuple(r) for r in jaccard.groups(docs, percent=percent).collect()]
    assert order(found) == order(linked(rows, percent))


def test_small_and_large_sets_meet(spark, docs, monkeypatch):
    rng = random.Random(3)
    rows = []
    for n in (30, 31, 33, 36, 40, 44, 60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for k in range(12):
            words = list(base)
            for _ in range(k % 4):
                words[rng.randrange(n)] = f"v{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words[: n - k % 3]), "en", "s", 0))
    df = spark.createDataFrame(rows, docs.schema)
    want = order(linked(rows))
    for bound in (0, 8, 12, 27, 41, 1000):
        monkeypatch.setattr(jaccard, "boundary", lambda sets, shared, percent, bound=bound: bound)
        assert order([tuple(r) for r in jaccard.groups(df).collect()]) == want, bound


def test_copies_on_both_sides_of_the_boundary(spark, docs, monkeypatch):
    # Sets of 35 or 36 shingles lie below 0.9 * 41, their only partners between that and 41.
    rows = []
    for i in range(60):
        for k in range(2 if i % 3 else 4):
            words = [f"w{i}x{j}" for j in range(37 + i % 2)] + [f"v{i}x{k}x{j}" for j in range(2 if k % 2 else 0)]
            rows.append((len(rows), " ".join(words if k < 2 else words[: len(words) - k // 3]), "en", "s", 0))
    df = spark.createDataFrame(rows, docs.schema)
    monkeypatch.setattr(jaccard, "boundary", lambda sets, shared, percent: 41)
    assert order([tuple(r) for r in jaccard.groups(df).collect()]) == order(linked(rows))


def test_crowded_lists_meet_block_by_block(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    assert order([tuple(r) for r in jaccard.groups(docs).collect()]) == order(linked(rows))


def test_keep_one(docs, rows, crowded):
    kept = jaccard.keep_one(crowded)
    assert kept.columns == crowded.columns
    found = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    least = {c for i, n, c in linked(rows) if n}
    wordless = [i if i is not None else -1 for i, n, _ in linked(rows) if not n]
    assert found == sorted([*least, *wordless])


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (200, 250), (250, 300)]
    rng.shuffle(links)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links] * 2
    for room in (components.TASK_LINKS, 0):
        got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long"), room).collect()}
        assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys((200, 250, 300), 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_tables_and_more_columns(empty, crowded, docs):
    for operator in (window_dedup.kept_words, repeats.kept_bytes, jaccard.groups):
        assert operator(empty).collect() == []
        assert order([tuple(r) for r in operator(crowded).collect()]) == order([tuple(r) for r in operator(docs).collect()])
    assert jaccard.keep_one(empty).collect() == []


def test_passages_go_from_400_bytes_on(spark, docs):
    """Passages of over 50 words that two documents share: their bytes decide, not their words."""
    rng, rows, gone = random.Random(9), [], {}
    for i, size in enumerate([300, 380, 398, 399, 400, 401, 450, 900] * 2):
        passage = ""
        while len(passage) < size:
            passage += "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) + " "
        passage = passage[:size]
        assert len(passage.split()) > 50
        for side in "xy":
            # Different bytes around it, so that nothing else is shared.
            rows.append((len(rows), f"{side * 40}{i}{side}|{passage}|{side}{i}{side * 40}" if side == "x" else f"{side * 40}{i}{side}<{passage}>{side}{i}{side * 40}", "en", "s", 0))
            gone[len(rows) - 1] = size if size >= 400 else 0
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.kept_bytes(spark.createDataFrame(rows, docs.schema).repartition(3)).collect()}
    assert got == {k: (n, int(n > 0)) for k, n in gone.items()}


def test_lists_tell_a_pair_once_and_leave_out_refuted_ones(spark):
    """Fifty lists of the same six sets: a task tells each pair once, and every list that has something to tell has a row."""
    names = [bytes([k] * 16) for k in range(6)]
    rows = [(one, 6, name, 10, bytes(8), name, [names[0]] if name == names[5] else None) for one in range(50) for name in names]
    df = spark.createDataFrame(rows, "list long, n int, set binary, size long, sketch binary, component binary, refuted array<binary>")
    found = jaccard.proposals(df, 90, 1).collect()
    pairs = [(r.a, r.b) for r in found if r.a is not None]
    assert {r.list for r in found} == set(range(50)) and len(pairs) <= 4 * 5
    assert len(set(pairs)) == 5 and (names[0], names[5]) not in pairs
    # Sets of one component have nothing to propose.
    assert jaccard.proposals(df.withColumn("component", F.lit(b"x")), 90, 8).where("list IS NOT NULL").isEmpty()


def near_misses(n):
    """Sets of 58 shingles, of which any two differ in eight, and at most six are a link; two thirds of them have a copy that is one."""
    rows = []
    for k in range(n):
        words = [f"a{k}", f"b{k}", *[f"w{j}" for j in range(56)], f"c{k}", f"d{k}"]
        rows.append((len(rows), " ".join(words), "en", "s", 0))
        if k % 3:
            rows.append((len(rows), " ".join([*words[:-1], f"e{k}"]), "en", "s", 0))
    return rows


def test_a_group_of_near_misses_gives_rows_by_members_not_by_pairs(spark, docs, monkeypatch):
    rows, made = near_misses(90), Counter()
    kept = jaccard.common.stored

    def counted(df, purpose, files=None):
        out = kept(df, purpose, files)
        made[purpose] += out.count()
        return out

    monkeypatch.setattr(jaccard.common, "stored", counted)
    found = [tuple(r) for r in jaccard.groups(spark.createDataFrame(rows, docs.schema)).collect()]
    assert order(found) == order(linked(rows))
    assert sum(made[p] for p in ("proposals", "fresh", "answers", "candidates", "links-verified")) <= 6 * len(rows)


@pytest.mark.parametrize("tokens", [100, 1 << 21])
def test_whole_sets_meet_block_by_block(spark, docs, monkeypatch, tokens):
    rows = near_misses(24)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", tokens)
    assert order([tuple(r) for r in jaccard.groups(spark.createDataFrame(rows, docs.schema)).collect()]) == order(linked(rows))


def test_merged_lists_hold_all_that_met(spark):
    rng = random.Random(4)
    lists = [set(rng.sample(range(40), 38)) for _ in range(30)] + [set(rng.sample(range(100, 9000), 3)) for _ in range(30)]
    rows = [(k, name) for k, names in enumerate(lists) for name in names]
    merged = {}
    for r in jaccard._merged(spark.createDataFrame(rows, "list long, name long"), 1).collect():
        merged.setdefault((r.list, r.n), set()).add(r.name)
    assert all(n == len(names) for (_, n), names in merged.items())
    assert all(any(names <= other for other in merged.values()) for names in lists)
    assert sum(map(len, merged.values())) < len(rows) / 2


def test_tables_on_the_way_to_near_copies_are_removed(spark, docs):
    jaccard.groups(spark.createDataFrame(near_misses(3), docs.schema))
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    found = jaccard.groups(spark.createDataFrame(near_misses(6), docs.schema))
    assert [name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before] == ["near-copies"]
    assert found.count() == 10
