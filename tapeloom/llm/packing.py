"""Pack documents into sequences of bounded length: shortest pack first, over the histogram of lengths.

Documents become token ids; whole sequences are cut off long ones, and what remains
of each is a piece shorter than a sequence. The histogram of piece lengths has a row
per length, whatever the corpus, so the packing is found on the driver: lengths are
placed longest first, always into the packs with most room, all packs of a kind at
once, so a kind is a pattern of lengths with a count. Every pattern gets a range of
sequence ids, every place in it a range of ranks within its length, and pieces find
their place by their rank. A rank is the number of pieces of that length in earlier
partitions plus those before it in its own.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from . import common

CAPACITY = 2048
#: Id that ends a document.
END = 1
#: Documents whose pieces a task hands on at once.
SLICE = 256


class Vocabulary:
    """The ranks, the splitting pattern and the added tokens of a byte-level BPE, read on the driver.

    The string of an added token is one id, also inside a text.
    """

    def __init__(self, path: str | None = None, pattern: str | None = None, added: dict[str, int] | None = None):
        if path is None or pattern is None:
            import public_tokenizers

            if path is None and added is None:
                with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as whole:
                    added = {token["content"]: token["id"] for token in json.load(whole)["added_tokens"]}
            path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
            pattern = pattern or public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = pattern
        self.added = added or {}

    def encoder(self):
        import tiktoken

        return tiktoken.Encoding("given", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=self.added)


def pieces(docs: DataFrame, identity: str, text: str, vocabulary: Vocabulary, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, part, place[, ids]) of every piece.

    `place` counts the pieces of the same length before it in its partition `part`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [identity, "start", "length", "ids_crc32", "doc_tokens", "part", "place", *["ids"] * with_ids]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, seen = TaskContext.get().partitionId(), shared.value.encoder(), defaultdict(int)
        encode = partial(encoder.encode, allowed_special="all") if shared.value.added else encoder.encode_ordinary
        # What leaves at once holds the ids of few documents, here and in the JVM.
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            rows: list[tuple] = []
            for i, content in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(content or ""), END], "<u4")
                for start in range(0, len(ids), capacity):
                    own = ids[start : start + capacity]
                    rows.append((i, start, len(own), zlib.crc32(own.tobytes()), len(ids), part, seen[len(own)], own))
                    seen[len(own)] += 1
            at, *columns, every = list(zip(*rows, strict=True)) or [()] * 8
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)]
            if with_ids:
                flat = np.concatenate([np.zeros(0, np.int32), *every]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, every)]), pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    fields = [docs.schema[identity], *(T.StructField(n, T.LongType()) for n in names[1:7])]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    return docs.select(F.col(f"`{identity}`"), F.col(f"`{text}`")).mapInArrow(task, T.StructType(fields))


def shortest_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of the patterns that hold all pieces of the histogram."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max((r for r, packs in room.items() if packs), default=0)
            if most < length:
                # Nothing has room: new packs, as full of this length as they get.
                each = capacity // length
                for count, copies in ((left // each, each), (1 if left % each else 0, left % each)):
                    if count:
                        room[capacity - copies * length].append((count, (length,) * copies))
                break
            count, pattern = room[most].pop()
            used = min(count, left)
            if count > used:
                room[most].append((count - used, pattern))
            room[most - length].append((used, (*pattern, length)))
            left -= used
    return [pack for r in sorted(room) for pack in room[r]]


class Places:
    """Where the piece of a length and rank goes."""

    def __init__(self, patterns: list[tuple[int, tuple[int, ...]]]):
        ranks: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for count, lengths in patterns:
            offset = 0
            for length in lengths:
                rows.append((length, ranks[length], sequence, offset))
                ranks[length] += count
                offset += length
            sequence += count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.key = self._key(table[:, 0], table[:, 1])
        self.rank, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    @staticmethod
    def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (length << 44) | rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, self._key(length, rank), "right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def pack(docs: DataFrame, identity: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece.

    NULL and empty texts are documents of the end id alone. Repeated rows and ties
    in length are pieces of their own. An empty table gives no rows.
    """
    vocabulary = vocabulary or Vocabulary()
    cut = common.stored(pieces(docs, identity, text, vocabulary, capacity, with_ids), "packing-pieces")
    counts = common.stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    # A row per length, `capacity` at most.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(Places(shortest_first(histogram, capacity)))
    order = Window.partitionBy("length").orderBy("part")
    before = counts.select("length", "part", (F.sum("n").over(order) - F.col("n")).alias("before"))
    shown = [identity, "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    ranked = cut.join(before, ["length", "part"]).select(*[F.col(f"`{c}`") for c in shown], (F.col("before") + F.col("place")).alias("rank"))

    # Lengths and ranks go to Python; the ids stay in the rows.
    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = shared.value.find(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["sequence_id", "offset"])

    placed = ranked.withColumn("rank", place("length", "rank"))
    return placed.select(*[F.col(f"`{c}`") for c in shown], "rank.sequence_id", "rank.offset")
