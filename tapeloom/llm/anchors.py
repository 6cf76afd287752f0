"""Find repeated windows by their anchors.

Each window of `window` symbols (bytes or words) has an anchor: the least by hash of
its runs of `gram` symbols, the first on ties. The anchor depends on the window's
content only, so equal windows have equal anchors at equal places. The windows that
share an anchor lie side by side; the stretch they cover is the anchor's context.
So a text of n symbols has about 2n / (window - gram + 1) contexts, every window is
in exactly one of them, and

* windows of contexts with different anchors differ;
* if a context occurs twice, so does each of its windows;
* what is left to compare are the different contexts of one anchor, which are the
  surroundings of the ends of repeats.

A context is told by the 64-bit hash of its anchor and another one of its content
and the anchor's place in it, 128 bits together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from . import common, textarrays as ta
from .textarrays import U64

#: Symbols that are worked on at once; positions take the low bits of a sort key.
SLICE = 1 << 19
_PLACE = U64((1 << 22) - 1)


@dataclass
class Found:
    """Anchors of some texts: text, places of anchor, first and last window, hashes."""

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    context: np.ndarray


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(U64).max, U64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _of(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Found:
    n = len(symbols)
    if n < window:
        none = np.zeros(0, np.int64)
        return Found(none, none, none, none, none.view(U64), none.view(U64))
    hashes = ta.Hashes(symbols)
    grams = hashes.runs(gram)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    least = (_least(keys, window - gram + 1) & _PLACE).astype(np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    start = np.flatnonzero(np.arange(window, len(least) + window) <= ends)
    at = least[start]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(new)
    final = np.append(begin[1:], len(at))[: len(begin)] - 1
    at, first, last = at[begin], start[begin], start[final]
    context = ta.mix(hashes.of(first, last + window) + ta.mix((at - first).astype(U64) + U64(1)))
    text = np.searchsorted(bounds, first, "right") - 1
    base = bounds[text]
    return Found(text, at - base, first - base, last - base, grams[at], context)


def find(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Iterator[Found]:
    """Anchors of the texts symbols[bounds[i] : bounds[i + 1]], piece by piece."""
    for a, b in ta.parts(bounds, SLICE):
        low, high = int(bounds[a]), int(bounds[b])
        # A long text goes in pieces that share no window.
        for begin in range(low, max(high - window, low) + 1, SLICE):
            end = min(high, begin + SLICE + window - 1) if high - low > SLICE else high
            own = np.array([0, end - begin]) if high - low > SLICE else bounds[a : b + 1] - low
            found = _of(symbols[begin:end], own, window, gram)
            for places in (found.at, found.first, found.last):
                places += begin - low
            found.text += a
            yield found


def byte_symbols(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, symbols, bounds) of runs of texts, a symbol for each byte."""
    data, offsets = ta.flat(column)
    for a, b in ta.parts(offsets, SLICE):
        yield a, ta.BYTE[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]


def word_symbols(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same with a symbol for each word."""
    data, offsets = ta.flat(column)
    for a, b in ta.parts(offsets, SLICE):
        words = ta.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        yield a, words.hashes(), words.first


Symbols = Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]


@dataclass(frozen=True)
class Unit:
    """What is compared: symbols of a text, window and gram length in symbols."""

    symbols: Symbols
    window: int
    gram: int


def identified(docs: DataFrame, identity: str, text: str) -> DataFrame:
    """(id, key, text): the id and a hash of the text tell the rows apart; equal rows are one."""
    content = F.col(f"`{text}`")
    return docs.select(F.col(f"`{identity}`").alias("id"), F.xxhash64(content).alias("key"), content.alias("text"))


def rows(docs: DataFrame, unit: Unit, wanted=None) -> DataFrame:
    """(id, key, at, first, last, anchor, context) of every context.

    `wanted`, if given, makes a test of anchors in each task; the others are left out.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = wanted() if wanted else None
        for batch in batches:
            for base, symbols, bounds in unit.symbols(batch.column(2)):
                for found in find(symbols, bounds, unit.window, unit.gram):
                    keep = test(found.anchor) if test else slice(None)
                    text = pa.array(found.text[keep] + base)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(text), batch.column(1).take(text)]
                        + [pa.array(x[keep], pa.int32()) for x in (found.at, found.first, found.last)]
                        + [pa.array(ta.signed(x[keep]), pa.int64()) for x in (found.anchor, found.context)],
                        names=["id", "key", "at", "first", "last", "anchor", "context"],
                    )

    schema = T.StructType(
        [docs.schema["id"], T.StructField("key", T.LongType())]
        + [T.StructField(n, T.IntegerType()) for n in ("at", "first", "last")]
        + [T.StructField(n, T.LongType()) for n in ("anchor", "context")]
    )
    return docs.select("id", "key", "text").mapInArrow(task, schema)


def contexts(found: DataFrame) -> DataFrame:
    """One row per different context of every anchor that occurs twice or more.

    (anchor, context, copies, id, key, at, first, last of one copy, variants:
    how many different contexts the anchor has).
    """
    copy = F.min(F.struct("id", "key", "at", "first", "last")).alias("copy")
    different = common.stored(found.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("copies"), copy), "contexts")
    sizes = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants"), F.sum("copies").alias("total")).where("total > 1")
    return different.join(sizes.select("anchor", "variants"), "anchor").select("anchor", "context", "copies", "copy.*", "variants")


def with_texts(docs: DataFrame, different: DataFrame) -> DataFrame:
    """(text, places): every text that holds chosen copies, with those."""
    places = different.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "context", "copies", "at", "first", "last")).alias("places"))
    same = F.expr("d.id <=> p.id AND d.key = p.key")
    return docs.alias("d").join(places.alias("p"), same).select("d.text", "p.places")


def _places(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(text of each place, its fields) of a column of lists of places."""
    inner = column.flatten()
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    return owner, {f.name: inner.field(i).to_numpy() for i, f in enumerate(inner.type)}


def windows(docs: DataFrame, different: DataFrame, unit: Unit) -> DataFrame:
    """(anchor, context, copies, window, back): every window of the chosen copies; `back` symbols before the anchor it begins."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, place = _places(batch.column(1))
            for base, symbols, bounds in unit.symbols(batch.column(0)):
                hashes = ta.Hashes(symbols)
                mine = np.flatnonzero((owner >= base) & (owner < base + len(bounds) - 1))
                for some in np.array_split(mine, max(1, len(mine) // 4096)):
                    first, last, at = (place[n][some].astype(np.int64) for n in ("first", "last", "at"))
                    count = last - first + 1
                    row = np.repeat(np.arange(len(some)), count)
                    begin = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                    back = at[row] - begin
                    absolute = begin + bounds[owner[some] - base][row]
                    content = ta.mix(hashes.of(absolute, absolute + unit.window) + ta.mix(back.astype(U64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place[n][some][row]) for n in ("anchor", "context", "copies")]
                        + [pa.array(ta.signed(content)), pa.array(back, pa.int32())],
                        names=["anchor", "context", "copies", "window", "back"],
                    )

    return with_texts(docs, different).mapInArrow(task, "anchor long, context long, copies long, window long, back int")


def repeated_windows(docs: DataFrame, different: DataFrame, unit: Unit) -> DataFrame:
    """(anchor, context, ahead, back): the outermost repeated windows of each context.

    Windows are counted over all contexts by content; `ahead` and `back` are how far
    before the anchor the first and the last repeated one begin.
    """
    every = common.stored(windows(docs, different, unit), "windows")
    twice = every.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor", "window")
    return every.join(twice, ["anchor", "window"]).groupBy("anchor", "context").agg(F.max("back").alias("ahead"), F.min("back").alias("back"))


def whole(different: DataFrame) -> DataFrame:
    """The same for contexts that occur twice or more: all their windows do."""
    return different.where("copies > 1").select("anchor", "context", (F.col("at") - F.col("first")).alias("ahead"), (F.col("at") - F.col("last")).alias("back"))


def covered(docs: DataFrame, found: DataFrame, outer: DataFrame, window: int) -> DataFrame:
    """(id, key, text, spans): all rows, with the [from, to) of symbols in repeated windows.

    All windows of a context hold its anchor, so what its repeated ones cover is one span.
    """
    span = F.struct((F.col("at") - F.col("ahead")).alias("from"), (F.col("at") - F.col("back") + window).alias("to"))
    spans = found.join(outer, ["anchor", "context"]).groupBy("id", "key").agg(F.collect_set(span).alias("spans"))
    return docs.alias("d").join(spans.alias("s"), F.expr("d.id <=> s.id AND d.key = s.key"), "left").select("d.id", "d.key", "d.text", "s.spans")


def marked(spans: list | None, length: int) -> np.ndarray:
    """Which of the symbols lie in a span."""
    steps = np.zeros(length + 1, np.int64)
    for span in spans or ():
        steps[span["from"]] += 1
        steps[span["to"]] -= 1
    return np.cumsum(steps)[:length] > 0


def id_type(docs: DataFrame) -> T.DataType:
    return docs.schema["id"].dataType


def key_of(text: Column) -> Column:
    return F.xxhash64(text)
