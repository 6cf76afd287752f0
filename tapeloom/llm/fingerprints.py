"""Fingerprints of texts from their improbable features.

A feature is a window of 64 bytes. Its byte entropy falls into one of 768 classes,
and classes are ranked by how rare they are among all windows of the corpus, the
rarest first; windows that are next to constant rank last. Of every 64 neighbours the
window of least rank gets a point, and windows with 16 points or more are the text's
features (less is asked of texts with fewer windows, and a text shorter than a window
is one feature). Different features, in order of appearance, go into Bloom filters of
2,048 bits by five bits each; a filter takes 160 features, then the chain gets another.

Two chains are alike by the mean, over the filters of the one with fewer features,
weighted by their features, of the best match in the other: common bits between what
two unrelated filters of their sizes have by chance (0) and all that they could have (1).

Order is by descending id. Texts are dealt once by ranges of that order; the first
text of a range is also sent to the range before, so that every task finds the next
document of each of its own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import common, textarrays as ta
from .textarrays import U64

WINDOW, NEIGHBOURS, POINTS = 64, 64, 16
BITS, PROBES, FEATURES = 2048, 5, 160
#: Share of what two filters can have in common, beyond chance, that is taken for chance still.
CUT = 0.3

# Entropy from sums of c * log2(c) over the counts c of a window's bytes, in whole
# 1024ths, so that sums are exact: 6 - sum / 64 bits.
_SUM = np.round([c * np.log2(max(c, 1)) * 1024 for c in range(WINDOW + 2)]).astype(np.int32)
_MOST = int(_SUM[WINDOW])
_SHIFT = 9
CLASSES = (_MOST >> _SHIFT) + 1
#: Windows of less than half a bit of entropy rank last.
WEAK = CLASSES // 12
_GROWS = np.diff(_SUM).astype(np.int32)
#: Symbols that are worked on at once; small enough for a processor's cache.
SLICE = 1 << 17
_PLACE = np.uint32((1 << 22) - 1)


def classes(data: np.ndarray) -> np.ndarray:
    """The entropy class of every window of `data`, by its first byte."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    ahead, behind = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for step in range(1, WINDOW):
        equal = (data[step:] == data[:-step]).view(np.uint8)
        ahead[:-step] += equal
        behind[step:] += equal
    # Byte i leaves with its equals ahead, byte i + WINDOW comes to its equals behind.
    change = _GROWS[behind[WINDOW:]] - _GROWS[ahead[: n - 1]]
    total = np.empty(n, np.int32)
    total[0] = _SUM[np.bincount(data[:WINDOW])].sum()
    np.cumsum(change, out=total[1:])
    total[1:] += total[0]
    return (_MOST - total) >> _SHIFT


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last, from, to): runs of whole texts, or parts of a long one.

    Parts of a long text overlap by what a window's rank and its points depend on.
    """
    for a, b in ta.parts(bounds, SLICE):
        low, high = int(bounds[a]), int(bounds[b])
        if high - low <= 2 * SLICE:
            yield a, b, low, high
        else:
            for begin in range(low, high, SLICE):
                yield a, b, begin, min(high, begin + SLICE)


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy class, the rarest in the corpus first; a row per class on the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CLASSES, np.int64)
        for batch in batches:
            data, offsets = ta.flat(batch.column(0))
            for a, b, low, high in _slices(offsets):
                found = classes(data[low : min(high + WINDOW - 1, int(offsets[b]))])
                starts = np.arange(low, low + len(found))
                owner = np.searchsorted(offsets[a + 1 : b + 1], starts, "right") + a
                count += np.bincount(found[starts + WINDOW <= offsets[owner + 1]], minlength=CLASSES)
        kept = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), pa.array(count[kept])], names=["class", "n"])

    counted = docs.select(F.col(f"`{text}`")).mapInArrow(task, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    total = np.zeros(CLASSES, np.int64)
    for row in counted.collect():
        total[row["class"]] = row["n"]
    return ranks(total)


def ranks(counts: np.ndarray) -> np.ndarray:
    """Places of the classes by count, weak classes behind all others; ties to the higher entropy."""
    weak = np.arange(len(counts)) < WEAK
    order = np.lexsort((-np.arange(len(counts)), counts, weak))
    place = np.empty(len(counts), np.uint32)
    place[order] = np.arange(len(counts), dtype=np.uint32)
    return place


def _least(keys: np.ndarray) -> np.ndarray:
    """The least of each key and the NEIGHBOURS - 1 behind it, or as many as there are."""
    n = len(keys)
    padded = np.full(-(-(n + NEIGHBOURS - 1) // NEIGHBOURS) * NEIGHBOURS, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    blocks = padded.reshape(-1, NEIGHBOURS)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[NEIGHBOURS - 1 : n + NEIGHBOURS - 1])


def features(data: np.ndarray, bounds: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the features of texts data[bounds[i] : bounds[i + 1]], in order, each once a text."""
    texts, hashes = [], []
    size = np.diff(bounds)
    for a, b, low, high in _slices(bounds):
        whole = high - low == bounds[b] - bounds[a]
        # What surrounds a part decides about windows near its ends.
        begin = low if whole else max(int(bounds[a]), low - NEIGHBOURS + 1)
        end = high if whole else min(int(bounds[b]), high + NEIGHBOURS + WINDOW - 2)
        part = data[begin:end]
        found = classes(part)
        n = len(found)
        if n:
            starts = np.arange(begin, begin + n)
            owner = np.searchsorted(bounds[a + 1 : b + 1], starts, "right") + a
            valid = starts + WINDOW <= bounds[owner + 1]
            keys = np.where(valid, rank[found] << np.uint32(22), np.uint32(0xFFFFFFFF) - _PLACE) | np.arange(n, dtype=np.uint32)
            points = np.bincount((_least(keys) & _PLACE)[valid], minlength=n)
            needed = np.minimum(POINTS, size[owner] - WINDOW + 1)
            chosen = np.flatnonzero(valid & (points >= needed) & (starts >= low) & (starts < high))
            values = ta.Hashes(ta.BYTE[part]).of(chosen, chosen + WINDOW)
            texts.append(owner[chosen])
            hashes.append(values)
        if whole:
            short = np.flatnonzero((size[a:b] > 0) & (size[a:b] < WINDOW)) + a
            if len(short):
                texts.append(short)
                hashes.append(ta.Hashes(ta.BYTE[data[low:high]]).of(bounds[short] - low, bounds[short + 1] - low))
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    text, value = np.concatenate(texts), np.concatenate(hashes)
    # Parts and short texts come in order of texts but for the short ones.
    order = np.argsort(text, kind="stable")
    text, value = text[order], value[order]
    by_value = np.lexsort((value, text))
    new = np.ones(len(text), bool)
    new[1:] = (text[by_value][1:] != text[by_value][:-1]) | (value[by_value][1:] != value[by_value][:-1])
    first = np.sort(by_value[new])
    return text[first], value[first]


class Chain:
    """Bloom filters of a text: rows of 64-bit words, and how many features each has."""

    def __init__(self, values: np.ndarray):
        count = -(-len(values) // FEATURES)
        bits = np.zeros((count, BITS), np.uint8)
        mixed = ta.mix(values)
        row = np.arange(len(values)) // FEATURES
        for probe in range(PROBES):
            bits[row, (mixed >> U64(11 * probe)) & U64(BITS - 1)] = 1
        self.filters = np.packbits(bits, axis=1, bitorder="little").view(U64) if count else np.zeros((0, BITS // 64), U64)
        self.sizes = np.bincount(row, minlength=count).astype(np.int64) if count else np.zeros(0, np.int64)

    def text(self) -> str:
        """Features in all, then the filters in base 64; a chain of none is `0:`."""
        return f"{int(self.sizes.sum())}:{base64.b64encode(self.filters.tobytes()).decode()}"


def parsed(text: str) -> Chain:
    count, _, filters = text.partition(":")
    chain = Chain(np.zeros(0, U64))
    chain.filters = np.frombuffer(base64.b64decode(filters), U64).reshape(-1, BITS // 64)
    chain.sizes = np.full(len(chain.filters), FEATURES)
    if len(chain.sizes):
        chain.sizes[-1] = int(count) - FEATURES * (len(chain.sizes) - 1)
    return chain


_EMPTY_SHARE = (1 - 1 / BITS) ** PROBES


def likeness(one: Chain, other: Chain) -> float:
    """From 0 to 1; two chains without a feature are alike, one without is like no other."""
    a, b = sorted((one, other), key=lambda c: (int(c.sizes.sum()), c.filters.tobytes()))
    if not len(a.sizes):
        return 0.0 if len(b.sizes) else 1.0
    if a.filters.shape == b.filters.shape and (a.filters == b.filters).all():
        return 1.0
    mine, theirs = (np.bitwise_count(c.filters).sum(axis=1).astype(np.int64) for c in (a, b))
    total = 0.0
    clear = _EMPTY_SHARE**b.sizes
    step = max(1, (1 << 16) // len(b.sizes))
    for i in range(0, len(a.sizes), step):
        own, n = a.filters[i : i + step], a.sizes[i : i + step]
        both = np.bitwise_count(own[:, None, :] & b.filters[None, :, :]).sum(axis=2, dtype=np.int64)
        most = np.minimum(mine[i : i + step, None], theirs[None, :])
        empty = _EMPTY_SHARE**n
        chance = BITS * (1 - empty[:, None]) * (1 - clear[None, :])
        least = np.minimum(chance + CUT * np.maximum(most - chance, 0), most - 1)
        score = np.clip((both - least) / (most - least), 0, 1)
        total += float((score.max(axis=1) * n).sum())
    return min(1.0, total / float(a.sizes.sum()))


def chains(texts: list[bytes], rank: np.ndarray) -> list[Chain]:
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    text, value = features(np.frombuffer(b"".join(texts), np.uint8), bounds, rank)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [Chain(value[cut[i] : cut[i + 1]]) for i in range(len(texts))]


def _edges(docs: DataFrame, identity: str, text: str) -> tuple[list[int], list[int]]:
    """Where ranges of the order (id, NULL last; hash of the text) begin: a row per range."""
    small = _ordered(docs, identity, text).select("reverse", "key")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    dealt = small.repartitionByRange(ranges, "reverse", "key").groupBy(F.spark_partition_id().alias("range"))
    found = sorted(tuple(r["first"]) for r in dealt.agg(F.min(F.struct("reverse", "key")).alias("first")).collect())
    return [r[0] for r in found], [r[1] for r in found]


def _ordered(docs: DataFrame, identity: str, text: str) -> DataFrame:
    """(id, text, reverse, key): whole numbers as ids; ~id turns their order round, NULL last."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    number = F.bitwise_not(F.col(f"`{identity}`").cast("bigint"))
    return docs.select(F.col(f"`{identity}`").alias("id"), content.alias("text"), F.coalesce(number, F.lit((1 << 63) - 1)).alias("reverse"), F.xxhash64(content).alias("key"))


def fingerprint(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text ends with the beginning of the next document's instead of its own
    last third; the next one is that of the next smaller id (NULL ids last, equal ids by
    the hash of the text, then as they come), the first after the last. A table of one
    row is its own next. NULL and empty texts have no feature: two such are alike (1),
    and like no other text (0). Repeated rows follow each other. Ids are whole numbers.
    An empty table gives no rows.
    """
    rank = rarity(docs, text)
    firsts, keys = _edges(docs, identity, text)
    schema = T.StructType(
        [T.StructField(identity, docs.schema[identity].dataType), T.StructField("n_chars", T.LongType())]
        + [T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]
    )
    if not firsts:
        return docs.sparkSession.createDataFrame([], schema)
    # Found in two steps, so that a row is not held against every range.
    wide = int(len(firsts) ** 0.5) + 1
    longs = lambda values: F.lit(values).cast("array<bigint>")
    groups = [F.arrays_zip(longs(firsts[i : i + wide]).alias("r"), longs(keys[i : i + wide]).alias("k")) for i in range(0, len(firsts), wide)]
    tops = F.arrays_zip(longs(firsts[::wide]).alias("r"), longs(keys[::wide]).alias("k"))
    place = F.struct(F.col("reverse").alias("r"), F.col("key").alias("k"))
    outer = F.greatest(F.size(F.filter(tops, lambda c: c <= place)), F.lit(1))
    rows = _ordered(docs, identity, text).withColumn("outer", outer)
    inner = F.greatest(F.size(F.filter(F.element_at(F.array(*groups), F.col("outer")), lambda c: c <= place)), F.lit(1))
    rows = rows.withColumn("range", (F.col("outer") - 1) * wide + inner - 1)
    starts = (F.element_at(longs(firsts), F.col("range") + 1) == F.col("reverse")) & (F.element_at(longs(keys), F.col("range") + 1) == F.col("key"))
    # The first of a range is the next one of the last in the range before.
    before = F.pmod(F.col("range") - 1, F.lit(len(firsts)))
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("range"), F.lit(True).alias("guest"))
    spread = rows.select("id", "text", "reverse", "key", F.explode(F.when(starts, F.array(own, guest)).otherwise(F.array(own))).alias("at"))
    dealt = spread.select("at.range", "at.guest", "reverse", "key", "id", "text").repartition("range").sortWithinPartitions("range", "guest", "reverse", "key")

    def results(group: list[tuple], rank: np.ndarray) -> pa.RecordBatch:
        """Rows of (id, text, next text); neighbours share texts."""
        own = [g[1] for g in group]
        edited = []
        for _, mine, following in group:
            count = len(mine) // 3
            edited.append((mine[: len(mine) - count] + following[:count]).encode())
        last = group[-1][2]
        made = chains([*(x.encode() for x in own), last.encode(), *edited], rank)
        n = len(group)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in group], kind), pa.array([len(x) for x in own], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
                pa.array([c.text() for c in made[:n]]), pa.array([c.text() for c in made[n + 1 :]]),
                pa.array([likeness(made[i], made[n + 1 + i]) for i in range(n)]), pa.array([likeness(made[i], made[i + 1]) for i in range(n)]),
            ],
            names=schema.names,
        )

    kind = to_arrow_type(docs.schema[identity].dataType)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, group, bytes_ = None, [], 0  # the last row whose next is not known yet, and finished ones
        for batch in batches:
            for at, visits, identity_, text_ in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)), strict=True):
                if open_ is not None and open_[0] == at:
                    group.append((open_[1], open_[2], text_))
                    bytes_ += len(open_[2])
                open_ = None if visits else (at, identity_, text_)
                if group and (bytes_ > SLICE or open_ is None):
                    yield results(group, rank)
                    group, bytes_ = [], 0
        if group:
            yield results(group, rank)

    return dealt.mapInArrow(task, schema)
