"""Remove passages of words that occur elsewhere.

Two passes over the texts. In the first, every partition makes a count-min sketch of
its windows, each entered under its anchor (see `anchors`), once per context; the
sketches are merged by adding their cells. An anchor that the merged sketch counts once has
windows that occur once, so the sketch overestimates and loses none. The second pass
groups exactly, by content, only the windows that the sketch holds for repeated.

The merged sketch is what every task gets, as one bit per cell: its size is bounded
by `MOST_CELLS` whatever the corpus. Its width follows the corpus up to that bound;
beyond, it lets more windows through to the exact pass, and the result is the same.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from . import anchors, common, textarrays as ta
from .textarrays import U64

WINDOW = 35
GRAM = 8
UNIT = anchors.Unit(anchors.word_symbols, WINDOW, GRAM)
#: Rows of the sketch.
DEPTH = 3
#: Cells per row, by the bytes of all texts: there is an anchor for about 80 bytes.
BYTES_PER_CELL = 32
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 28
#: Cells that are merged and sent together.
BLOCK = 1 << 18
#: Anchors that a task gathers before it sends a sketch of them.
GATHERED = 1 << 19
SALTS = 16


def _cells(anchor: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The cell of each anchor, row by row; row r has the cells from r * width."""
    for row in range(DEPTH):
        yield (ta.mix(anchor + U64(row + 1)) & U64(width - 1)).astype(np.int64) + row * width


def _packed(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells of a block with counts of 1 or 2 (2 or more)."""
    steps = np.diff(cells, prepend=0).astype(np.uint32) * 2 + (counts > 1)
    return zlib.compress(steps.astype(np.uint32).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.frombuffer(zlib.decompress(data), np.uint32)
    return np.cumsum(steps >> 1, dtype=np.int64), (steps & 1).astype(np.uint8) + 1


def blocks(cells: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    cuts = np.flatnonzero(np.diff(cells // BLOCK)) + 1
    for own, n in zip(np.split(cells, cuts), np.split(counts, cuts), strict=True):
        if len(own):
            yield int(own[0]) // BLOCK, _packed(own % BLOCK, n)


def rows(found: list[tuple[int, bytes]], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in found], pa.int32()), pa.array([salt] * len(found), pa.int32()), pa.array([d for _, d in found], pa.binary())],
        names=["block", "salt", "cells"],
    )


SKETCH = "block int, salt int, cells binary"


def _partial(docs: DataFrame, unit: anchors.Unit, width: int) -> DataFrame:
    def sketch(parts: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        gathered = np.concatenate(parts)
        for cells in _cells(gathered, width):
            yield from blocks(*np.unique(cells, return_counts=True))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, parts, size = TaskContext.get().partitionId() % SALTS, [], 0
        for batch in batches:
            for _, symbols, bounds in unit.symbols(batch.column(0)):
                for found in anchors.find(symbols, bounds, unit.window, unit.gram):
                    parts.append(found.anchor)
                    size += len(found.anchor)
                    if size >= GATHERED:
                        yield rows(list(sketch(parts)), salt)
                        parts, size = [], 0
        if size:
            yield rows(list(sketch(parts)), salt)

    return docs.select("text").mapInArrow(task, SKETCH)


def _merged(sketches: DataFrame, last: bool) -> DataFrame:
    """Blocks added up; the last time as bits of the cells that count 2 or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for block, salt, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells, counts = _unpacked(data)
                own = held.setdefault((block, -1 if last else salt), np.zeros(BLOCK, np.uint8))
                own[cells] = np.minimum(own[cells] + counts, 2)
        for (block, salt), own in held.items():
            cells = np.flatnonzero(own)
            yield rows([(block, np.packbits(own > 1).tobytes() if last else _packed(cells, own[cells]))], salt)

    return sketches.repartition(*(["block"] if last else ["block", "salt"])).mapInArrow(task, SKETCH)


def width_for(docs: DataFrame) -> int:
    """Cells per row: a power of two that follows the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, total // BYTES_PER_CELL - 1).bit_length()))


def bits_of(sketches: DataFrame, cells: int) -> np.ndarray:
    """The merged sketch as bits: set for cells that count 2 or more."""
    bits = np.zeros(max(cells, BLOCK) // 8, np.uint8)
    for row in _merged(_merged(sketches, False), True).select("block", "cells").toLocalIterator():
        bits[row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = np.frombuffer(row["cells"], np.uint8)
    return bits


def repeated_anchors(docs: DataFrame, unit: anchors.Unit = UNIT, width: int | None = None):
    """A maker of tests, for use in tasks: which anchors does the merged sketch count twice or more?"""
    width = width or width_for(docs)
    bits = bits_of(_partial(docs, unit, width), DEPTH * width)
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def make():
        held = np.frombuffer(shared.value, np.uint8)

        def test(anchor: np.ndarray) -> np.ndarray:
            twice = np.ones(len(anchor), bool)
            for cells in _cells(anchor, width):
                twice &= (held[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 > 0
            return twice

        return test

    return make


def repeated_spans(docs: DataFrame, unit: anchors.Unit = UNIT, width: int | None = None) -> DataFrame:
    """(id, key, text, spans) for rows (id, key, text): the words in windows that occur elsewhere."""
    found = common.stored(anchors.rows(docs, unit, repeated_anchors(docs, unit, width)), "anchors")
    different = common.stored(anchors.contexts(found), "variants")
    ends = anchors.repeated_windows(docs, different.where("variants > 1"), unit)
    outer = ends.unionByName(anchors.whole(different.where("variants = 1")))
    return anchors.covered(docs, found, outer, unit.window)


def kept_words(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every document.

    NULL and empty texts have no words, and the hash of nothing. Repeated rows are
    elsewhere for each other. Texts shorter than a window stay whole. An empty
    table gives no rows.
    """
    found = repeated_spans(anchors.identified(docs, identity, text))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, digests = [], [], []
            for content, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                # Splits at the same white space as the words elsewhere.
                words = (content or "").encode().split()
                out = anchors.marked(spans, len(words))
                n.append(len(words))
                gone.append(int(out.sum()))
                digests.append(hashlib.sha256(b" ".join(w for w, x in zip(words, out.tolist(), strict=True) if not x) if spans else b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=[identity, "n_words", "n_removed", "kept_sha256"],
            )

    schema = T.StructType(
        [T.StructField(identity, anchors.id_type(found)), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    return found.select("id", "text", "spans").mapInArrow(task, schema)
