from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tapeloom.llm import langid, outliers, packing, pii, statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


# --- statistics and outliers --------------------------------------------------------


def measured(text):
    text = text or ""
    words, seen, lines = WORD.findall(text), set(), 0
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    for line in text.split("\n"):
        lines += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered))


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\r\t$#\x85", max_size=40)), max_size=10))
@settings(max_examples=150, deadline=None)
def test_statistics(texts):
    found = statistics.measure(pa.array(texts, pa.string()))
    assert list(zip(*[found[n].tolist() for n in statistics.NAMES], strict=True)) == [measured(t) for t in texts]


def test_chi_square():
    # For four degrees the survival function is exp(-x / 2) (1 + x / 2).
    point = outliers.chi2_point(0.99, 4)
    assert abs(np.exp(-point / 2) * (1 + point / 2) - 0.01) < 1e-9
    assert abs(outliers.chi2_below(outliers.chi2_point(0.5, 1), 1) - 0.5) < 1e-9


def judged(rows, share=outliers.SHARE, steps=outliers.STEPS, least=outliers.LEAST):
    """Verdicts by numpy, group by group."""
    stats = [measured(r[1]) for r in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]

    def vector(s):
        n, chars, symbols, lines, again = s
        return [np.log(chars / max(n, 1) + 0.001), symbols / (symbols + n + 1), lines / (lines + 0.1 * n + 1), np.arcsin(np.sqrt(min(again / max(n, 1), 1)))]

    groups = defaultdict(list)
    for i, r in enumerate(rows):
        if not failed[i]:
            groups[r[2], r[3]].append(i)
    kinds, pools = defaultdict(list), defaultdict(int)
    for (lang, _), own in groups.items():
        pools[lang] += len(own) if len(own) < least else 0
    for k, own in groups.items():
        kinds[k if len(own) >= least else ("pool", k[0]) if pools[k[0]] >= least else ""] += own
    floor, kept = np.diag(outliers.SPREAD**2), [False] * len(rows)
    swell = share / outliers.chi2_below(outliers.chi2_point(share, 4), 6)
    for own in kinds.values():
        x = np.array([vector(stats[i]) for i in own])
        cells = np.sort(np.floor(x * 1000), axis=0)[(len(own) + 1) // 2 - 1]
        center, inverse = (cells + 0.5) / 1000, np.linalg.inv(floor)
        for step in range(steps + 1):
            d = np.maximum(np.einsum("ni,ij,nj->n", x - center, inverse, x - center), 0)
            if step == steps:
                break
            bins = np.floor(np.log2(d + 1e-9) * outliers.BINS)
            near = x[bins <= np.sort(bins)[int(np.ceil(len(own) * share)) - 1]]
            center = near.mean(axis=0)
            inverse = np.linalg.inv(np.cov(near.T, bias=True) * swell + floor)
        for i, distance in zip(own, d, strict=True):
            kept[i] = bool(distance <= outliers.chi2_point(1 - outliers.ALPHA, 4))
    return [(r[0], *s, f, k) for r, s, f, k in zip(rows, stats, failed, kept, strict=True)]


@pytest.mark.parametrize("least", [outliers.LEAST, 8])
def test_outliers(docs, rows, least):
    found = outliers.judge(docs, least=least).drop("distance").collect()
    assert order([tuple(r) for r in found]) == order(judged(rows, least=least))


def test_symbols_are_rejected_and_prose_is_kept(spark, docs, rows):
    prose = [r for r in rows if r[1] and measured(r[1])[0] >= 50 and measured(r[1])[4] * 2 <= measured(r[1])[0]]
    junk = [(1000 + i, re.sub(r"(\S) ", r"\1### ", r[1]), *r[2:]) for i, r in enumerate(prose[:9])]
    verdicts = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(prose + junk, docs.schema)).collect()}
    assert not any(verdicts[j[0]] for j in junk)
    assert sum(verdicts[r[0]] for r in prose if "z" * 100 not in r[1]) >= len(prose) - 2


def test_outlier_edges(empty, crowded, docs, rows):
    assert outliers.judge(empty).collect() == [] and outliers.keep(empty).collect() == []
    kept = outliers.keep(crowded)
    assert kept.columns == crowded.columns
    want = sorted(str(r[0]) for r in judged(rows) if r[-1])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


# --- language -----------------------------------------------------------------------


def cuts(word, pieces):
    if not word:
        yield []
    for d in range(1, len(word) + 1):
        if word[:d] in pieces:
            for rest in cuts(word[d:], pieces):
                yield [word[:d], *rest]


def small_model():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b"bc", " é".encode(), b"c a"})
    weights = np.random.default_rng(0).random((len(pieces), 3))
    return langid.Model(pieces, ["x", "y", "z"], weights / weights.sum(axis=0))


@pytest.mark.parametrize("word", [b" abc", b" ababc", " éa".encode(), b" abcabcab", b" "])
def test_sums_over_all_segmentations(word):
    model = small_model()
    place = {p: i for i, p in enumerate(model.pieces)}
    each = [(c, np.prod([model.probabilities[place[p]] for p in c], axis=0)) for c in cuts(word, place)]
    total = sum(p for _, p in each)
    assert np.allclose(model.words([word])[0], np.log(total)) and np.allclose(model.long_word(word), np.log(total))
    expected = np.zeros_like(model.probabilities)
    for c, p in each:
        for piece in c:
            expected[place[piece]] += p / total * np.array([1, 2, 0])
    assert np.allclose(model.expected([word], np.array([[1, 2, 0]])), expected)


def test_long_words_stay_in_range():
    model = small_model()
    assert np.isfinite(model.long_word(b" " + b"abc" * 5000)).all()
    word = b" " + b"abcab" * 9
    assert np.allclose(model.long_word(word), model.words([word])[0])


def test_long_words_are_learned_from(spark, docs, monkeypatch):
    model, counts = small_model(), np.array([[1, 2, 0], [3, 0, 5]])
    words = [b" abcab" * 7, " éabcc a".encode() * 5]
    short = model.expected(words, counts)
    whole = [model.expected([w * 40], counts[:1]) for w in words]
    sizes = np.array([len(p) for p in model.pieces])
    assert all(np.allclose(sizes @ own, len(w) * 40 * counts[0]) for own, w in zip(whole, words, strict=True))
    monkeypatch.setattr(langid, "LONG", 4)
    assert short.sum() > 0 and np.allclose(model.expected(words, counts), short)
    monkeypatch.undo()
    # Clauses of 48 bytes and more, as in scripts without blanks.
    rng = np.random.default_rng(4)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 25)) for _ in range(6))
    rows = [(i, text("のはをにがでとたしてい" if i % 2 else "的一是不了人我在有他这"), "ja" if i % 2 else "zh", "s", 0) for i in range(30)]
    df = spark.createDataFrame(rows, docs.schema)
    fitted = langid.fit(df.where("doc_id < 20"))
    assert fitted.langs == ["ja", "zh"]
    assert all(r.lang_pred == ("ja" if r.doc_id % 2 else "zh") for r in langid.predict(df, fitted).collect())


def test_held_out_accuracy(docs, rows):
    held = langid.held_out(F.col("doc_id"))
    found = langid.predict(docs, langid.fit(docs.where(~held))).withColumn("held_out", held).collect()
    known = {(r[0], r[2]) for r in rows}
    sure = [r for r in found if r.lang_pred != "und" and r.held_out and any((r.doc_id, x) in known for x in ("en", "fr"))]
    right = [(r.doc_id, r.lang_pred) in known for r in sure]
    assert len(right) > 10 and sum(right) >= 0.95 * len(right)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))


def test_language_edges(empty, crowded, docs):
    model = langid.fit(docs)
    assert langid.predict(empty, model).collect() == []
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}
    plain = lambda df: order([(r.doc_id, r.lang_pred, round(r.score, 9)) for r in df.collect()])
    assert plain(langid.predict(crowded, langid.fit(crowded))) == plain(langid.predict(docs, model))


# --- personal data --------------------------------------------------------------------


def base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in reversed(m.group()) if c.isdigit()]
        if 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


@given(st.text(alphabet="a1@.+- (2\n%é4", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_base_patterns(text):
    assert pii.base_spans(text)[0] == base(text)


def test_base_patterns_take_time_in_proportion():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def some_model(spark, docs):
    rng = np.random.default_rng(1)
    texts = []
    for i in range(300):
        number = "".join(map(str, rng.integers(0, 10, 15)))
        number += next(d for d in "0123456789" if pii.luhn(number + d))
        phone = f"+1 ({rng.integers(100, 999)}) {rng.integers(100, 999)}-{rng.integers(1000, 9999)}"
        ip = ".".join(map(str, rng.integers(1, 255, 4)))
        texts.append(f"word {[phone, number, ip, f'x.{i}@mail{i % 9}.example.com', f'{i}.5', str(rng.integers(10, 99999)), f'v{i}.{i}.0'][i % 7]} other")
    return pii.train(pii.sample(spark.createDataFrame([(t,) for t in texts], "text string"), "text"))


def test_the_field_adds_what_runs_together(spark, docs):
    model = some_model(spark, docs)
    text = "call +1 (269) 555-3296 4524132264652876 now, or 4387393285946913 +1 (438) 555-5817"
    found, every = pii.find(text, model)
    assert {(k, text[a:b]) for k, a, b in every} == {
        ("phone", "+1 (269) 555-3296"), ("card", "4524132264652876"), ("card", "4387393285946913"), ("phone", "+1 (438) 555-5817"),
    }
    assert set(found) <= set(every) and len(found) < 4
    for clean in ("version 4.0.", "in 1999 and 2004", "12345", "chapter 3", "a1 b2 c3"):
        assert pii.find(clean, model) == ([], [])


def test_decoding_is_the_best_segmentation(spark, docs):
    model = some_model(spark, docs)
    zone = "+1 (269) 555-3296 12"
    n, found = pii.segments(zone)
    best = (-np.inf, None)
    for size in range(3):
        for chosen in itertools.combinations(found, size):
            if any(a.last > b.first for a, b in itertools.pairwise(chosen)):
                continue
            for kinds in itertools.product(range(4), repeat=size):
                score, at, last = 0.0, 0, 0
                for s, k in zip(chosen, kinds, strict=True):
                    for target in [0] * (s.first - at) + [k + 1]:
                        score += model.follows[last, target]
                        last = target
                    score += model.scores(s.features)[k]
                    at = s.last
                for _ in range(n - at):
                    score += model.follows[last, 0]
                    last = 0
                best = max(best, (score, [(pii.KINDS[k], s.start, s.end) for s, k in zip(chosen, kinds, strict=True)]), key=lambda x: x[0])
    assert pii.best(zone, model) == best[1]


def test_forward_and_backward_agree():
    rng = np.random.default_rng(4)
    follows = rng.normal(size=(5, 5))
    spans = [(0, 2), (1, 3), (1, 4), (3, 5)]
    scores = [rng.normal(size=4) for _ in spans]
    starts, ends = [[] for _ in range(6)], [[] for _ in range(6)]
    for (a, b), s in zip(spans, scores, strict=True):
        starts[a].append((b, s))
        ends[b].append((a, s))
    assert np.isclose(np.logaddexp.reduce(pii._forward(5, ends, follows)[5]), pii._backward(5, starts, follows)[0, 0])


def test_spans_of_a_table(docs, rows, empty, crowded):
    found = pii.spans(docs).collect()
    want = Counter()
    for i, text, *_ in rows:
        spans = sorted(base(text or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        want[(i, *(sum(k == x for k, _, _ in spans) for x in pii.KINDS), hashlib.sha256(pii.joined(spans).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:-1] for r in found) == want
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1] or "")
    for r in found:
        for kind, a, b in base(next(iter(texts[r.doc_id]))) if len(texts[r.doc_id]) == 1 else ():
            assert f"{kind}:{a}:{b}" in r.spans.split(",")
    assert pii.spans(empty).collect() == [] and pii.mask(empty).collect() == []
    hidden = pii.mask(crowded)
    assert hidden.columns == crowded.columns and hidden.count() == len(rows)
    for r in hidden.collect():
        assert r.text is None or not base(r.text)
        assert r.doc_id is None or r.n_chars == len(r.text or "")


# --- packing --------------------------------------------------------------------------


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=20))
@settings(max_examples=200, deadline=None)
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_first(histogram, 64)
    held = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64
        for length in lengths:
            held[length] += count
    assert held == histogram
    # Two packs that would fit into one are left only where nothing was longer.
    assert sum(c for c, p in patterns if 2 * sum(p) <= 64) <= 1


def test_packing(docs, rows, empty, crowded):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, text, *_ in rows:
        want[i, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    found = packing.pack(docs, with_ids=True).collect()
    sequences = defaultdict(list)
    for r in found:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    pieces = Counter((r.doc_id, r.start, tuple(r.ids), r.doc_tokens) for r in found)
    cut = Counter()
    for (i, ids), n in want.items():
        for start in range(0, len(ids), packing.CAPACITY):
            cut[i, start, ids[start : start + packing.CAPACITY], len(ids)] += n
    assert pieces == cut
    total = sum(r.length for r in found)
    assert len(sequences) * packing.CAPACITY <= 1.03 * total + packing.CAPACITY
    assert packing.pack(empty).collect() == []
    assert packing.pack(crowded).count() == len(found)


def test_long_texts_are_encoded_whole():
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encoder = packing.Vocabulary().encoder()
    for text in ("a" * 50000, " " * 50000 + "x", "é" * 20000, "\n\t" * 9000, "<|endoftext|> it's  a\n\n b"):
        assert encoder.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_one_id(spark, docs):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n\n  y <|endoftext", "\n <|endoftext|>it's", "plain"]
    found = packing.pack(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], docs.schema), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in found} == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_small_groups_are_judged_by_language(spark):
    """Own groups from 10 rows on, then the small ones of a language, then all that are left."""
    sizes = {("en", "big"): 12, ("en", "a"): 6, ("en", "b"): 5, ("de", "a"): 4, ("de", "b"): 3, (None, "a"): 2, ("", None): 10, ("zh", "a"): 10}
    rows = [(lang, source) for (lang, source), n in sizes.items() for _ in range(n)]
    named = spark.createDataFrame(rows, "lang string, source string").select("lang", "source", outliers._group("lang", "source").alias("own"))
    kinds = outliers._kinds(named, 10)
    got = {(r.lang, r.source): r.kind for r in named.distinct().join(kinds, "own").collect()}
    assert len(got) == len(sizes)
    alone = [got["en", "big"], got["", None], got["zh", "a"]]
    assert len(set(alone)) == 3 and got["en", "a"] == got["en", "b"] not in [*alone, ""]
    assert {got["de", "a"], got["de", "b"], got[None, "a"]} == {""}


def test_token_ids_stay_in_the_rows(spark, docs):
    """Ids are made once and written; finding places sends lengths and ranks to Python, not ids."""
    packed = packing.pack(docs, with_ids=True)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ids" not in next(line for line in plan.splitlines() if "ArrowEvalPython" in line).split("[")[1].split("]")[0]
