"""Link documents whose sets of word shingles are nearly equal: size-aware join.

Equal sets are one set from the start. For the others, tokens (shingles) have one
order in the whole corpus: those that a sketch counts once, others, frequent ones. Of a set of s tokens any partner
shares t = ceil(s * percent / 100) at least, so the first s - t + c tokens of both
have c in common. Small sets enumerate the subsets of c = 2 of these; large sets are
looked up in inverted lists of their first s - t + 1 tokens, where the small sets
that could be their partners stand too. Partners are of nearly equal size, so both
kinds of list are kept apart by classes of size, and a set stands in the class below
as well if a partner could. The boundary between small and large is the
size where the subsets to be enumerated cost more than the lists to be scanned,
counted over the corpus.

Members of one list or subset are compared by parity sketches: bit i tells whether
an odd number of tokens falls on i, so two sketches differ in at most as many bits
as the sets in tokens, and a pair with too many is no link. Lists that nearly
agree are one list. What the sketches allow is first proposed tree-wise by one list
per set and counted exactly, by the whole sets. Between the components that gives,
the members with a partner by their sketches meet once more with their whole sets,
and only links found exactly, a tree of them per group, leave a task: a group of
near copies gives rows in proportion to its members, not to its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from . import anchors, common, components, textarrays as ta, window_dedup
from .textarrays import U64

PERCENT = 90
SHINGLE = 3
SUBSET = 2
#: A token is frequent if one of so many documents has it. A corpus has at most
#: FREQUENT times the mean set size of these, which bounds what tasks are sent.
FREQUENT = 500
#: Tokens a task gathers before it looks for frequent ones.
GATHERED = 1 << 20
#: Sketch bits: least power of two over half the tokens, within these. At a tenth of
#: the tokens differing few bits are hit twice; what slips through is checked exactly.
LEAST_BITS, MOST_BITS = 64, 8192
#: Files of the tables of proposals and answers, some fifty bytes a row.
FILES = 32
#: Members of a list that meet in one group, and their tokens where whole sets meet; longer lists meet block by block.
BLOCK, BLOCK_TOKENS = 1024, 1 << 21
#: Bits of a sketch made of a whole set, as a multiple of those that are sent, and their bound.
FINER, MOST_FINE_BITS = 32, 1 << 16
#: Costs of a member of a list, whose sketch is sent along, and of a comparison of sketches, in rows.
MEMBER, COMPARED = 20.0, 1 / 64
#: First sizes of the classes.
CLASSES = [1, *(math.ceil(8 * 1.5**i) for i in range(80))]
_SHARED, _LATE = U64(1 << 62), U64(1 << 63)
#: Bytes of text for a cell of the sketch of tokens, and its most cells (32 MB of bits).
BYTES_PER_CELL, MOST_CELLS = 8, 1 << 28


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bounds, tokens) of runs of texts: distinct hashes of shingles, by text."""
    data, offsets = ta.flat(column)
    for a, b in ta.parts(offsets, anchors.SLICE):
        words = ta.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes = ta.Hashes(words.hashes(ta.LOWERED))
        count = np.diff(words.first)
        # Few words are one shingle.
        shingles = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        text = np.repeat(np.arange(b - a), shingles)
        start = words.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        token = hashes.of(start, start + np.minimum(count, width)[text])
        order = np.lexsort((token, text))
        token, text = token[order], text[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
        yield a, np.searchsorted(text[new], np.arange(b - a + 1)), token[new]


def least_overlap(size: int, percent: int) -> int:
    return -(-size * percent // 100)


def order_of_tokens(docs: DataFrame, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(bits, frequent): what the common order of tokens goes by, in one pass over the texts.

    `bits` tells for a quarter of all tokens, by hash, whether a merged count sketch
    of one row counts them twice or more; tokens that it counts once come first.
    `frequent` are the hashes of frequent tokens, the rarer ones first; they come
    last. A set whose first tokens occur nowhere else has no partner, and most
    sets are done with that. Any order gives the same links.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells_wide = min(MOST_CELLS, max(window_dedup.BLOCK, 1 << max(0, total // BYTES_PER_CELL - 1).bit_length()))

    def seen(parts: list[np.ndarray], n: int, salt: int) -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(parts), return_counts=True)
        often = count >= max(4, n / FREQUENT)
        heavy = np.stack([token[often], count[often].astype(U64)])
        chosen = _judged(token)
        cells, inverse = np.unique(_cell(token[chosen], cells_wide), return_inverse=True)
        blocks = list(window_dedup.blocks(cells, np.bincount(inverse, count[chosen]).astype(np.int64)))
        return window_dedup.rows([(-1, heavy.tobytes()), *blocks], salt)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, parts, texts, size = TaskContext.get().partitionId() % window_dedup.SALTS, [], 0, 0
        for batch in batches:
            for _, bounds, token in _sets(batch.column(0), width):
                parts.append(token)
                texts += len(bounds) - 1
                size += len(token)
                if size >= GATHERED:
                    yield seen(parts, texts, salt)
                    parts, texts, size = [], 0, 0
        if parts:
            yield seen(parts, texts, salt)

    found = common.stored(docs.select("text").mapInArrow(task, window_dedup.SKETCH), "tokens-seen")
    bits = window_dedup.bits_of(found.where("block >= 0"), cells_wide)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                token, count = np.frombuffer(data, U64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ta.signed(token)), pa.array(count.astype(np.int64))], names=["token", "n"])

    heavy = found.where("block < 0").select("cells").mapInArrow(unpacked, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    least = max(4, docs.count() // FREQUENT)
    often = heavy.where(F.col("n") >= least).orderBy("n", "token").select("token").collect()
    return bits, np.array([r["token"] for r in often], np.int64).view(U64)


def _judged(token: np.ndarray) -> np.ndarray:
    return token >> U64(62) == 0


def _cell(token: np.ndarray, width: int) -> np.ndarray:
    return (ta.mix(token + U64(11)) & U64(width - 1)).astype(np.int64)


def _sketch(tokens: np.ndarray, finer: int = 1, most: int = MOST_BITS) -> bytes:
    bits = min(most, finer * max(LEAST_BITS, 1 << (len(tokens) // 2).bit_length()))
    odd = np.bincount((ta.mix(tokens) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _names(bounds: np.ndarray, token: np.ndarray) -> list[bytes | None]:
    """A 128-bit hash of each whole set, None of an empty one."""
    sums = [np.concatenate([np.zeros(1, U64), np.cumsum(ta.mix(token ^ U64(seed)))]) for seed in (3, 5)]
    both = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
    return [row.tobytes() if size else None for row, size in zip(both, np.diff(bounds), strict=True)]


def described(docs: DataFrame, bits: np.ndarray, frequent: np.ndarray, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(id, key, size, set, alone, prefix, sketch) of every document.

    `set` is a 128-bit hash of the whole set, NULL if it is empty; `prefix` the first
    tokens in the common order without the `alone` very first, which occur nowhere
    else and so are in no one's list; `sketch` the parity sketch.
    """
    shared = docs.sparkSession.sparkContext.broadcast((bits.tobytes(), frequent.tobytes()))
    smallest = math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, often = np.frombuffer(shared.value[0], np.uint8), np.frombuffer(shared.value[1], U64)
        ranked = np.argsort(often)
        sorted_often = often[ranked]
        for batch in batches:
            sizes, names, prefixes, sketches, alone = [], [], [], [], []
            for _, bounds, token in _sets(batch.column(2), width):
                order = (token >> U64(2)) | _SHARED
                chosen = np.flatnonzero(_judged(token))
                cell = _cell(token[chosen], 8 * len(held))
                once = chosen[(held[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0]
                order[once] ^= _SHARED
                if len(often):
                    at = np.minimum(np.searchsorted(sorted_often, token), len(often) - 1)
                    known = sorted_often[at] == token
                    order[known] = _LATE | ranked[at[known]].astype(U64)
                names += _names(bounds, token)
                for i in range(len(bounds) - 1):
                    own = slice(bounds[i], bounds[i + 1])
                    size = own.stop - own.start
                    sizes.append(size)
                    # Smaller sets have no partner but their equals.
                    wide = min(size, size - least_overlap(size, percent) + SUBSET) if size >= smallest else 0
                    first = np.sort(np.partition(order[own], wide - 1)[:wide]) if wide else np.zeros(0, U64)
                    alone.append(int(np.searchsorted(first, _SHARED)))
                    prefixes.append(first[alone[-1] :].view(np.int64))
                    sketches.append(_sketch(token[own]) if len(prefixes[-1]) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                    pa.array(alone, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ],
                names=["id", "key", "size", "set", "alone", "prefix", "sketch"],
            )

    schema = T.StructType(
        [docs.schema["id"], T.StructField("key", T.LongType()), T.StructField("size", T.LongType()), T.StructField("set", T.BinaryType()),
         T.StructField("alone", T.IntegerType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())]
    )
    return docs.select("id", "key", "text").mapInArrow(task, schema)


def _first(percent: int, more: int):
    """How many tokens of the prefix share `more` with those of any partner."""
    wide = (F.col("size") - F.ceil(F.col("size") * percent / 100) + more).cast("int") - F.col("alone")
    return F.greatest(F.lit(0), F.least(F.size("prefix"), wide))


def _level():
    """The class of a set's size."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in CLASSES]), lambda c: c <= F.col("size"))) - 1


def _levels(percent: int):
    """The classes in which a set stands: its own, and the one below if a partner may be there."""
    own = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col("level") + 1)
    below = (F.col("level") > 0) & (F.col("size") * percent <= (own - 1) * 100)
    return F.when(below, F.array("level", F.col("level") - 1)).otherwise(F.array("level"))


def _tokens(sets: DataFrame, percent: int) -> DataFrame:
    """(list, level, set, size): every set in the lists of its first tokens."""
    placed = sets.select("set", "size", "alone", "prefix").withColumn("level", _level()).withColumn("level", F.explode(_levels(percent)))
    tokens = placed.select("set", "size", "level", F.explode(F.slice("prefix", F.lit(1), _first(percent, 1))).alias("token"))
    return tokens.select(F.xxhash64("level", "token").alias("list"), "level", _name().alias("name"), "size")


def _name():
    """A set's short name: two sets of one name are both members wherever one is, and refuted later."""
    return F.xxhash64("set")


def _subsets(sets: DataFrame, percent: int) -> DataFrame:
    """(list, level, name, size): every set in the lists of the pairs of its first tokens."""
    placed = sets.select("set", "size", "alone", "prefix").withColumn("level", _level()).withColumn("level", F.explode(_levels(percent)))
    chosen = placed.withColumn("prefix", F.slice("prefix", F.lit(1), _first(percent, SUBSET)))
    pairs = chosen.select(_name().alias("name"), "size", "level", "prefix", F.posexplode("prefix").alias("at", "one"))
    pairs = pairs.select("name", "size", "level", "one", F.explode(F.slice("prefix", F.col("at") + 2, F.size("prefix"))).alias("other"))
    return pairs.select(F.xxhash64("level", "one", "other").alias("list"), "level", "name", "size")


def boundary(sets: DataFrame, shared: DataFrame, percent: int = PERCENT) -> int:
    """The size from which sets are looked up in lists: the first of a class.

    Per class, subsets cost a row each; lists a row per token, and for each that is
    `shared` (list, level, n) what its members and their comparisons cost.
    """
    n1, n2 = _first(percent, 1), _first(percent, SUBSET)
    rows = sets.withColumn("level", _level()).groupBy("level").agg(F.sum(n2 * (n2 - 1) / 2).alias("subsets"), F.sum(n1).alias("tokens"))
    pairs = shared.groupBy("level").agg(F.sum("n").alias("members"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    # A row per class of sizes.
    costs = {
        r["level"]: (r["subsets"], r["tokens"] + MEMBER * (r["members"] or 0) + COMPARED * (r["pairs"] or 0))
        for r in rows.join(pairs, "level", "left").collect()
    }
    ends = [0, *(x + 1 for x in sorted(costs))]
    best = min(ends, key=lambda end: sum(c[0] if x < end else c[1] for x, c in costs.items()))
    return CLASSES[best] if best else 0


def _shared(posted: DataFrame, percent: int) -> DataFrame:
    """Members of lists that have two or more, with the list's count, least size and two sums that tell its members.

    Two members alone must be near in size. Dealt by list once: what is counted
    there is joined there, and both sides read all columns, so that it is one exchange.
    """
    dealt = posted.repartition("list", "level")
    sums = [F.bit_xor(F.xxhash64("name", F.lit(seed))).alias(f"sum{seed}") for seed in (1, 2)]
    counted = dealt.groupBy("list", "level").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max("size").alias("most"), *sums)
    kept = counted.where((F.col("n") > 2) | ((F.col("n") == 2) & (F.col("least") * 100 >= F.col("most") * percent)))
    return dealt.join(kept.drop("most"), ["list", "level"])


def members(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(list, n, name) of lists with two members or more, once for each different group of members.

    Near copies share many tokens and so stand together in many lists; groups are
    told by count and two 64-bit sums of their members, and by whether the boundary cuts
    members off: what is left of such a list doesn't stand for the whole group. What
    differs by a few members is merged.
    """
    large = common.stored(_shared(_tokens(sets, percent), percent), "lists-of-tokens")
    counted = large.groupBy("list", "level").agg(F.count(F.lit(1)).alias("n"))
    bound = boundary(sets, counted, percent)
    # Large sets, and the small ones that could be their partners.
    small = common.stored(_shared(_subsets(sets.where(F.col("size") < bound), percent), percent), "lists-of-pairs")
    partner = F.col("size") * 100 >= bound * percent
    held = large.where(partner).withColumn("cut", F.col("least") * 100 < bound * percent).unionByName(small.withColumn("cut", F.lit(False)))
    once = held.groupBy("n", "sum1", "sum2", "cut").agg(F.min("list").alias("list"))
    return _merged(common.stored(held.join(once.select("list"), "list").select("list", "name"), "lists-once"), 1)


def _merged(held: DataFrame, seed: int) -> DataFrame:
    """(list, n, name) of (list, name): lists with the same least member by hash become one where that costs less.

    Two lists agree in it as often as they agree in their members. Whoever met in a
    list meets in the merged one too.
    """
    told = held.groupBy("list").agg(F.min(F.xxhash64("name", F.lit(seed))).alias("least"), F.count(F.lit(1)).alias("n"))
    told = common.stored(told, "lists-told")
    both = common.stored(held.join(told, "list").select("least", "name").distinct(), "lists-both")
    cost = lambda rows, pairs: MEMBER * rows + COMPARED * pairs
    apart = told.groupBy("least").agg(F.count(F.lit(1)).alias("lists"), cost(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).alias("apart"))
    one = both.groupBy("least").agg(F.count(F.lit(1)).alias("n"))
    one = apart.join(one, "least").where((F.col("lists") > 1) & (cost(F.col("n"), F.col("n") * (F.col("n") - 1) / 2) <= F.col("apart"))).select("least", "n")
    one = common.stored(one, "lists-merged", FILES)
    alone = told.join(one.select("least"), "least", "left_anti").select("list", "n")
    return held.join(alone, "list").select("list", "n", "name").unionByName(both.join(one, "least").select(F.col("least").alias("list"), "n", "name"))


def _folded(sketch: np.ndarray, width: int) -> np.ndarray:
    while sketch.shape[1] > width:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def near_pairs(sizes: np.ndarray, sketches: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, differing bits) of all pairs that may be links."""
    found = []
    width = np.array([len(s) for s in sketches])
    kinds = {w: np.flatnonzero(width == w) for w in np.unique(width)}
    packed = {w: np.frombuffer(b"".join(sketches[i] for i in at), np.uint8).reshape(len(at), w).view(U64) for w, at in kinds.items()}
    for w, rows in kinds.items():
        # Sizes of partners differ by less than a half, sketches by one doubling.
        for v in (w, 2 * w):
            if v not in kinds:
                continue
            columns, other = kinds[v], _folded(packed[v], w // 8)
            step = max(1, (1 << 21) // max(1, len(columns) * (w // 8)))
            for a in range(0, len(rows), step):
                at = rows[a : a + step]
                bits = np.bitwise_count(packed[w][a : a + step, None, :] ^ other[None, :, :]).sum(axis=2, dtype=np.int64)
                both = sizes[at][:, None] + sizes[columns][None, :]
                # 100 |A & B| >= percent |A u B| allows so many differing tokens.
                good = bits * (100 + percent) <= (100 - percent) * both
                good &= np.minimum(sizes[at][:, None], sizes[columns][None, :]) * 100 >= percent * np.maximum(sizes[at][:, None], sizes[columns][None, :])
                if v == w:
                    good &= at[:, None] < columns[None, :]
                i, j = np.nonzero(good)
                found.append((at[i], columns[j], bits[i, j]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Forest:
    def __init__(self, parent: int | list[int]):
        """From single nodes, or from what each node already hangs on."""
        self.parent = list(range(parent)) if isinstance(parent, int) else parent

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[x] = y
        return x != y


def _propose(rows: list[tuple], percent: int, trees: int) -> Iterator[tuple[bytes, bytes]]:
    """Links to check among members (set, size, sketch, component, refuted, side): `trees` forests without common edges.

    Members of one component are joined already.
    """
    sizes = np.array([r[1] for r in rows], np.int64)
    i, j, bits = near_pairs(sizes, [r[2] for r in rows], percent)
    crossing = any(r[5] for r in rows)
    place = {r[0]: k for k, r in enumerate(rows)}
    answered = {(min(k, place[o]), max(k, place[o])) for k, r in enumerate(rows) for o in r[4] or () if o in place}
    first: dict[bytes, int] = {}
    whole = np.array([first.setdefault(r[3], k) for k, r in enumerate(rows)])
    side = np.array([r[5] for r in rows])
    # Only what isn't joined yet; between two blocks only pairs across.
    open_ = whole[i] != whole[j]
    if crossing:
        open_ &= side[i] != side[j]
    i, j, bits = i[open_], j[open_], bits[open_]
    order = np.lexsort((j, i, bits))
    edges = [e for e in zip(i[order].tolist(), j[order].tolist(), strict=True) if (min(e), max(e)) not in answered]
    for _ in range(trees):
        forest, rest = _Forest(whole.tolist()), []
        for a, b in edges:
            if forest.join(a, b):
                yield min(rows[a][0], rows[b][0]), max(rows[a][0], rows[b][0])
            else:
                rest.append((a, b))
        if len(rest) == len(edges):
            return
        edges = rest


_PAIR = "list long, a binary, b binary"
#: Pairs that a task remembers as told.
TOLD = 1 << 18


def proposals(joined: DataFrame, percent: int, trees: int) -> DataFrame:
    """(list, a, b) from rows (list, n, set, size, sketch, component, refuted).

    A pair comes once from a task, whichever of its lists propose it; each list that
    proposes anything has a row, without a pair if others have told them all.
    """
    placed = _placed(joined, F.ceil(F.col("n") / BLOCK), "set", "size", "sketch", "component", "refuted")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, found, told = None, [], [], set()

        def add(group: tuple, rows: list[tuple]) -> None:
            offered = list(_propose(rows, percent, trees)) if len(rows) > 1 else []
            fresh = [pair for pair in offered if pair not in told]
            if len(told) < TOLD:
                told.update(fresh)
            found.extend((group[0], a, b) for a, b in fresh or [(None, None)] * bool(offered))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["list", "a", "b"]
            )

        for batch in batches:
            lists, ones, twos, *rest = (c.to_pylist() for c in batch.columns)
            for group, row in zip(zip(lists, ones, twos, strict=True), zip(*rest, strict=True), strict=True):
                if group != last:
                    add(last, rows)
                    if len(found) > 10000:
                        yield batch_of()
                        found.clear()
                    last, rows = group, []
                rows.append(row)
        add(last, rows)
        yield batch_of()

    return placed.mapInArrow(task, _PAIR)


def _placed(joined: DataFrame, blocks: Column, *columns: str) -> DataFrame:
    """(list, one, two, *columns, side): each member of a list once for every block of the list, with which its own block meets."""
    own = F.pmod(F.xxhash64("set"), F.col("blocks").cast("bigint")).cast("int")
    placed = joined.withColumn("blocks", blocks.cast("int")).withColumn("own", own).withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select(
        "list", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"),
        *columns, F.when(F.col("own") > F.col("with"), 1).otherwise(0).alias("side"),
    )
    # In the group of two blocks only pairs across are compared.
    placed = placed.withColumn("side", F.when(F.col("one") == F.col("two"), 0).otherwise(F.col("side") + 1))
    return placed.repartition("list", "one", "two").sortWithinPartitions("list", "one", "two", columns[0])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows, without their first three columns, of each group of the same three; the last but one column stays in Arrow's arrays."""
    last, rows = None, []
    for batch in batches:
        *columns, side = batch.columns
        groups = zip(*(c.to_pylist() for c in columns[:3]), strict=True)
        values, ends = None, None
        if pa.types.is_list(columns[-1].type):
            values, ends = columns[-1].values.to_numpy(), columns[-1].offsets.to_numpy()
        rest = [c.to_pylist() for c in (columns[3:] if values is None else columns[3:-1])]
        if values is not None:
            rest.append([values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
        for group, row in zip(groups, zip(*rest, side.to_pylist(), strict=True), strict=True):
            if group != last:
                if len(rows) > 1:
                    yield last[0], rows
                last, rows = group, []
            rows.append(row)
    if len(rows) > 1:
        yield last[0], rows


def _apart(rows: list[tuple], sketches: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(i, j, differing bits, whole) of pairs that may be links of members (.., size, component, .., side) and lie in two components.

    `whole` has the first member of each one's component.
    """
    i, j, bits = near_pairs(np.array([r[1] for r in rows], np.int64), sketches, percent)
    first: dict[bytes, int] = {}
    whole = np.array([first.setdefault(r[2], k) for k, r in enumerate(rows)])
    side = np.array([r[-1] for r in rows])
    open_ = (whole[i] != whole[j]) & ((side[i] != side[j]) | (side[i] == 0))
    return i[open_], j[open_], bits[open_], whole.tolist()


def candidates(joined: DataFrame, percent: int) -> DataFrame:
    """(list, name): the members that may have a link to another component, of rows (list, n, name, set, size, component, sketch)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, rows in _met(batches):
            i, j, *_ = _apart(rows, [r[3] for r in rows], percent)
            names = pa.array([rows[k][0] for k in np.unique(np.concatenate([i, j]))], pa.int64())
            if len(names):
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(names), pa.int64()), names], names=["list", "name"])

    placed = _placed(joined, F.ceil(F.col("n") / BLOCK), "name", "size", "component", "sketch")
    return placed.mapInArrow(task, "list long, name long").distinct()


def verified(joined: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join all that have one, of rows (list, n, total, set, size, component, tokens) with whole sets.

    Of two members that are joined already nothing is asked; all others that may be
    a link are counted here. `total` is the number of tokens of a list.
    """

    def linked(one: np.ndarray, two: np.ndarray) -> bool:
        common_size = len(np.intersect1d(one, two, assume_unique=True))
        return 100 * common_size >= percent * (len(one) + len(two) - common_size)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _met(batches):
            sets = [r[3] for r in rows]
            i, j, bits, whole = _apart(rows, [_sketch(s.view(U64), FINER, MOST_FINE_BITS) for s in sets], percent)
            order, forest, found = np.lexsort((j, i, bits)), _Forest(whole), []
            for at in range(0, len(order), 1 << 16):
                part = order[at : at + (1 << 16)]
                for a, b in zip(i[part].tolist(), j[part].tolist(), strict=True):
                    if forest.root(a) != forest.root(b) and linked(sets[a], sets[b]):
                        forest.join(a, b)
                        found.append((min(rows[a][0], rows[b][0]), max(rows[a][0], rows[b][0])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], names=["a", "b"])

    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_TOKENS))
    return _placed(joined, blocks, "set", "size", "component", "tokens").mapInArrow(task, "a binary, b binary").distinct()


#: Bits of the filter of wanted rows: a power of two over so many for each, up to a bound.
FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 28


def _filter(wanted: DataFrame) -> tuple[bytes, int]:
    """Bits by hash of the wanted rows (id, key), and their number; a word of 64 is a row."""
    bits = min(MOST_FILTER_BITS, max(64, 1 << (FILTER_BITS * wanted.count()).bit_length()))
    cell = F.pmod(F.col("key"), F.lit(bits))
    word, place = F.floor(cell / 64).cast("int"), F.pmod(cell, F.lit(64)).cast("int")
    words = wanted.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    held = np.zeros(bits // 64, np.int64)
    for row in words.toLocalIterator():
        held[row["word"]] = row["bits"]
    return held.tobytes(), bits


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set, tokens) for rows (id, key, set).

    Texts stay where they are: the filter, which lets through all wanted rows and
    few others, goes to the tasks, and only sets meet the wanted ones, by the name
    that joins them and drops copies in one exchange.
    """
    held, bits = _filter(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, np.int64).view(U64)
        for batch in batches:
            cell = batch.column(0).to_numpy().view(U64) & U64(bits - 1)
            chosen = batch.filter(pa.array((words[(cell >> U64(6)).astype(np.int64)] >> (cell & U64(63))) & U64(1) > 0))
            for _, bounds, token in _sets(chosen.column(1), width):
                yield pa.RecordBatch.from_arrays([pa.array(_names(bounds, token), pa.binary()), ta.lists(pa.array(ta.signed(token)), bounds)], names=["set", "tokens"])

    found = docs.select("key", "text").mapInArrow(task, "set binary, tokens array<long>")
    return found.join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"])


def _checked(full: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): the exact answer for different proposed links, by the whole sets (set, tokens).

    The sets are read once, for both ends of a pair, and only those asked for move.
    """
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("set")).join(full, "set")
    both = ends.groupBy("a", "b").agg(F.min_by("tokens", "set").alias("one"), F.max_by("tokens", "set").alias("two"))
    common_size = F.size(F.array_intersect("one", "two"))
    either = F.size("one") + F.size("two") - common_size
    return both.select("a", "b", (100 * common_size >= percent * either).alias("linked"))


def _open(listed: DataFrame, owned: DataFrame) -> DataFrame:
    """(list) of the lists whose members are in several components."""
    inside = listed.join(owned.select("name", "component"), "name")
    return inside.groupBy("list").agg(F.min("component").alias("one"), F.max("component").alias("two")).where("one <> two").select("list")


def links(docs: DataFrame, sets: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(a, b): links between different sets that join all that belong together.

    For rows (id, key, text) and one row (set, id, key, size, alone, prefix, sketch) per set.
    The first proposals come from one list per set, its longest. A list whose members
    these have joined is done. Of the others, the members that the sketches allow a
    link to another component meet with their whole sets, which answer for all their
    pairs at once.
    """
    listed = common.stored(members(sets, percent), "members")
    seen = sets.select(_name().alias("name"), "set", "size", "sketch")
    places = sets.select(_name().alias("name"), "set", "id", "key")

    longest = common.stored(listed.groupBy("name").agg(F.max_by("list", F.struct("n", "list")).alias("list")), "longest")
    sizes = longest.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = longest.join(sizes, "list").join(seen, "name").withColumn("component", F.col("set")).withColumn("refuted", F.lit(None).cast("array<binary>"))
    pairs = common.stored(proposals(joined.select("list", "n", "set", "size", "sketch", "component", "refuted"), percent, 1), "proposals")
    fresh = common.stored(pairs.where("a IS NOT NULL").select("a", "b").distinct(), "fresh", FILES)
    asked = fresh.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    asked = common.stored(asked.join(places.drop("name"), "set"), "sets-wanted", FILES)
    full = common.stored(_whole_sets(docs, asked, width), "sets-whole")
    known = common.stored(_checked(full, fresh, percent).where("linked").select("a", "b"), "links-proposed", FILES)

    labels = components.components(known)
    owned = seen.select("name", "set").join(labels.withColumnRenamed("node", "set"), "set", "left")
    owned = common.stored(owned.withColumn("component", F.coalesce("component", "set")), "components")
    rest = listed.join(_open(listed, owned), "list").join(seen, "name").join(owned.select("set", "component"), "set")
    left = common.stored(candidates(rest, percent), "candidates")
    if left.isEmpty():
        return known
    more = places.join(left.select("name").distinct(), "name").join(full.select("set"), "set", "left_anti")
    more = common.stored(more.select("set", "id", "key"), "sets-wanted", FILES)
    if not more.isEmpty():
        full = full.unionByName(common.stored(_whole_sets(docs, more, width), "sets-whole"))
    held = common.stored(_merged(left, 2).join(seen.select("name", "set", "size"), "name"), "meeting")
    totals = held.groupBy("list").agg(F.sum("size").alias("total"))
    whole = held.join(totals, "list").join(owned.select("set", "component"), "set").join(full, "set")
    return known.unionByName(common.stored(verified(whole, percent), "links-verified", FILES))


def _owned(rows: DataFrame, percent: int, width: int) -> DataFrame:
    """(id, key, size, component) of rows (id, key, text); no component without a shingle.

    Written once; the tables on the way there are removed.
    """
    return common.stored_alone(rows.sparkSession, lambda: _found(rows, percent, width), "near-copies")


def _found(rows: DataFrame, percent: int, width: int) -> DataFrame:
    known = common.stored(described(rows, *order_of_tokens(rows, width), percent, width), "sets")
    picked = F.min(F.struct("id", "key")).alias("one")
    once = known.where("size(prefix) > 0").groupBy("set").agg(picked, *[F.first(c).alias(c) for c in ("size", "alone", "prefix", "sketch")])
    # Equal sets have equal prefixes; a set without one has no partner.
    sets = common.stored(once.select("set", "one.id", "one.key", "size", "alone", "prefix", "sketch"), "sets-once")
    labels = components.components(links(rows, sets, percent, width)).withColumnRenamed("node", "set")
    return known.select("id", "key", "size", "set").join(labels, "set", "left").withColumn("component", F.coalesce("component", "set"))


def groups(docs: DataFrame, identity: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) of every document, by shingles of `width` words.

    `component_id` is the least id among the documents that links reach. Texts that
    are NULL, empty or without a word have no shingle and stand alone. Repeated
    rows are linked with each other. NULL ids are never the least unless there is
    no other. An empty table gives no rows.
    """
    owned = _owned(anchors.identified(docs, identity, text), percent, width)
    least = owned.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    return owned.join(least, "component", "left").select(
        F.col("id").alias(identity), F.col("size").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )


def keep_one(docs: DataFrame, identity: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """The rows of `docs` without near copies: of each group the one with the least id.

    Of repeated rows one stays; rows without a word all stay.
    """
    owned = _owned(anchors.identified(docs, identity, text), percent, width).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("one")
    kept = owned.groupBy("component").agg(first).select(F.to_json(F.struct("one.id")).alias("kept_id"), F.col("one.key").alias("kept_key"))
    whole, name, key, wordy = common.fresh(docs, "document", "row_id", "row_key", "wordy")
    content = F.col(f"`{text}`")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole),
        F.to_json(F.struct(F.col(f"`{identity}`").alias("id"))).alias(name),
        F.xxhash64(content).alias(key),
        F.coalesce(content.rlike(common.WORD), F.lit(False)).alias(wordy),
    )
    chosen = packed.where(wordy).join(kept.select(F.col("kept_id").alias(name), F.col("kept_key").alias(key)), [name, key]).dropDuplicates([name, key])
    return chosen.select(whole).unionByName(packed.where(~F.col(wordy)).select(whole)).select(f"{whole}.*")
