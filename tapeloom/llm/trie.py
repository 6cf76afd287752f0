"""The prefix trie of conversations, from padded matrices of turn ids.

A conversation is a row of turn ids, 64 to a panel; longer ones go on in further
panels, told apart by a hash of all turns before. Rows are sorted by panel, prefix and
ids and dealt by ranges, so the conversations below a node lie side by side. A task
takes its range in slices: a slice is a matrix, padded with zeros and ordered by
lexsort; the columns in which a row differs from the one before, or-accumulated from
the left, mark where nodes start, and reduceat over the starts sums up every depth.

Everything told of a node is a sum over its rows. A row stands for the nodes that it
starts (their words count once), for the leaf that ends with it if the next row doesn't
go on from it, and for its own words. So a node that crosses the border of a slice is
the sum of its parts, and only such nodes are recombined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common, mixing, ranking

#: Turns of a panel, and rows of a slice.
WIDTH, SLICE = 64, 4096
#: Conversations begin with up to KEEP - 1 turns of the first of their GROUP.
GROUP, KEEP = 20, 4
#: Panels of a conversation that are summed up together (2**12).
BLOCK_BITS = 12
EMPTY = hashlib.sha256(b"").hexdigest()

FINAL, PART, END = 0, 1, 2
_NODE = "kind int, depth long, k1 long, k2 long, conv long, n_convs long, n_children long, n_leaves long, saved long, ends string, up1 long, up2 long, parent long"
_SUMS = ("n_convs", "n_children", "n_leaves", "saved")


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, name, words): the turns of each conversation from 0, by content; texts stay behind."""
    said, by = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (text, role))
    name = F.unhex(F.md5(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary")))
    slim = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").alias("turn"), name.alias("name"), mixing.word_count(said).alias("words")
    )
    return common.stored(ranking.ranked(slim, "conv", ["turn", "name"]).select("conv", "at", "name", "words"), "trie-turns")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, name, words) after the change of beginnings, and (conv, turns), a row per conversation."""
    keep = F.crc32(F.col("conv").cast("string").cast("binary")) % KEEP
    sizes = common.stored(own.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    first = sizes.select(F.col("conv").alias("first"), F.least("n", F.lit(KEEP)).alias("there"))
    convs = sizes.withColumns({"first": F.col("conv") - F.col("conv") % GROUP, "keep": keep}).join(first, "first", "left")
    convs = convs.withColumn("lead", F.least("keep", F.coalesce("there", F.lit(0))))
    convs = common.stored(convs.withColumn("turns", F.col("lead") + F.greatest(F.col("n") - F.col("keep"), F.lit(0))), "trie-convs")
    # A first conversation has GROUP of them at most, and gives three turns at most.
    heads = own.where(F.col("at") < KEEP - 1).withColumnRenamed("conv", "first")
    lent = convs.where("lead > 0").join(heads, "first").where("at < lead").select("conv", "at", "name", "words")
    rest = own.where(F.col("at") >= keep).join(convs.select("conv", "keep", "lead"), "conv")
    return lent.unionByName(rest.select("conv", (F.col("at") - F.col("keep") + F.col("lead")).alias("at"), "name", "words")), convs.select("conv", "turns")


def _beyond(panels: DataFrame, sums: dict, later: bool) -> DataFrame:
    """`panels` with aggregates over a conversation's earlier (or later) panels, by blocks of panels."""
    block = panels.withColumn("block", F.shiftright("panel", BLOCK_BITS))
    order = F.col("panel").desc() if later else F.col("panel").asc()
    inner = Window.partitionBy("conv", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv").orderBy(F.col("block").desc() if later else F.col("block").asc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = block.groupBy("conv", "block").agg(*[f(F.col(c)).alias(n) for n, (f, c) in sums.items()])
    wide = totals.select("conv", "block", *[f(F.col(n)).over(outer).alias(f"{n}_far") for n, (f, _) in sums.items()])
    # Few conversations have more than one block.
    wide = wide.where(" OR ".join(f"{n}_far IS NOT NULL" for n in sums))
    near = block.withColumns({n: f(F.col(c)).over(inner) for n, (f, c) in sums.items()})

    def both(name: str, combine):
        a, b = F.coalesce(F.col(name), F.lit(0)), F.coalesce(F.col(f"{name}_far"), F.lit(0))
        return a.bitwiseXOR(b) if combine is F.bit_xor else a + b

    return near.join(wide, ["conv", "block"], "left").select(*panels.columns, *[both(n, f).cast("bigint").alias(n) for n, (f, _) in sums.items()])


def panels(sequences: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """(conv, panel, b1, b2, ids, words, after, more): `b1`, `b2` hash all turns before, `after` counts words behind."""
    keyed = sequences.withColumns({f"k{i}": F.xxhash64("name", "at", F.lit(i)) for i in (1, 2)}).withColumn("panel", F.floor(F.col("at") / width).cast("bigint"))
    each = F.sort_array(F.collect_list(F.struct("at", "k1", "k2", "words"))).alias("each")
    made = keyed.groupBy("conv", "panel").agg(each, F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"), F.sum("words").alias("w"))
    made = made.select(
        "conv", "panel", F.expr("transform(each, t -> struct(t.k1, t.k2))").alias("ids"), F.expr("transform(each, t -> t.words)").alias("words"), "x1", "x2", "w"
    )
    made = _beyond(made, {"b1": (F.bit_xor, "x1"), "b2": (F.bit_xor, "x2")}, False)
    made = _beyond(made, {"after": (F.sum, "w")}, True)
    made = made.join(convs, "conv").withColumn("more", F.col("turns") > (F.col("panel") + 1) * width)
    none = convs.where("turns = 0").select("conv", F.lit(0).cast("bigint").alias("panel"), F.lit(False).alias("more"))
    for name in ("b1", "b2", "after"):
        none = none.withColumn(name, F.lit(0).cast("bigint"))
    none = none.withColumns({"ids": F.array().cast(made.schema["ids"].dataType), "words": F.array().cast("array<bigint>")})
    columns = ("conv", "panel", "b1", "b2", "ids", "words", "after", "more")
    return made.select(*columns).unionByName(none.select(*columns))


class _Slice:
    """Own rows in order, with a row before and behind if there are any."""

    def __init__(self, rows: list[tuple], width: int, before: tuple | None, behind: tuple | None):
        # (panel, b1, b2, conv, k1, k2, words, after, more, deep_words, deep_leaf, next_starts)
        every = [*rows, *(x for x in (before, behind) if x)]
        size = np.array([len(r[4]) for r in every])
        self.width = max(1, int(size.max()))
        k1, k2 = (np.concatenate([np.asarray(r[i], np.int64) for r in every]) for i in (4, 5))
        row = np.repeat(np.arange(len(every)), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        matrix = np.zeros((len(every), self.width), np.int32)
        matrix[row, column] = self._dense(k1, k2) + 1
        group = self._dense(*(np.array([r[i] for r in every], np.int64) for i in (0, 1, 2)))
        conv = np.array([r[3] for r in every], np.int64)
        n = len(rows)
        # Of equal rows those that go on come last, so that a row before them is no leaf.
        more = np.array([r[8] for r in rows], bool)
        order = np.lexsort((conv[:n], more, *matrix[:n].T[::-1], group[:n]))
        line = np.concatenate([[n] if before else [], order, [n + bool(before)] if behind else []]).astype(np.int64)
        # Columns from the first that differs from the row above.
        changed = np.logical_or.accumulate((matrix[line][1:] != matrix[line][:-1]) | (group[line][1:] != group[line][:-1])[:, None], axis=1)
        all_ = np.ones((1, self.width), bool)
        self.up = changed[:n] if before else np.concatenate([all_, changed[: n - 1]])
        self.down = changed[-n:] if behind else np.concatenate([changed[len(changed) - n + 1 :], all_])
        self.alone = behind is None
        self.valid = matrix[order] > 0
        self.start = self.valid & self.up
        self.size, self.conv = size[order], conv[order]
        take = lambda i: np.array([rows[k][i] for k in order])
        self.panel, self.b1, self.b2 = take(0).astype(np.int64), take(1).astype(np.int64), take(2).astype(np.int64)
        self.after, self.more = take(7).astype(np.int64), more[order]
        self.deep_words, self.deep_leaf, self.next_starts = (take(i).astype(np.int64) for i in (9, 10, 11))
        grid = [np.zeros((len(every), self.width), np.int64) for _ in range(3)]
        for g, values in zip(grid, (k1, k2, None), strict=True):
            g[row, column] = values if values is not None else np.concatenate([np.asarray(r[6] if r[6] is not None else [0] * len(r[4]), np.int64) for r in every])
        self.x1, self.x2 = (np.bitwise_xor.accumulate(np.concatenate([b[:, None], g[order]], axis=1), axis=1)[:, 1:] for b, g in ((self.b1, grid[0]), (self.b2, grid[1])))
        words = grid[2][order]
        self.suffix = np.cumsum(words[:, ::-1], axis=1)[:, ::-1]
        self.new = (words * self.start).sum(axis=1)
        last = np.maximum(self.size - 1, 0)
        apart = self.down[np.arange(n), last]
        nothing = (self.size == 0) & ~((np.arange(n) == n - 1) & self.alone)
        self.leaf = (~self.more & apart & ~nothing).astype(np.int64)

    @staticmethod
    def _dense(*keys: np.ndarray) -> np.ndarray:
        """Ranks of tuples of values, from 0."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), np.int64)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    def attributed(self) -> pa.RecordBatch:
        """(conv, panel, own_words, leaf, starts) of the rows of later panels."""
        kept = self.panel > 0
        columns = (self.conv, self.panel, self.new, self.leaf, self.start[:, 0].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], names=["conv", "panel", "own_words", "leaf", "starts"])

    def nodes(self, width: int) -> Iterator[pa.RecordBatch]:
        n = len(self.conv)
        weight = self.leaf + self.deep_leaf
        fresh = self.new + self.deep_words
        first = self.panel == 0
        if first.any():
            own = {
                "conv": self.conv[first].min(), "n_convs": first.sum(), "n_children": self.start[first, 0].sum(), "n_leaves": weight[first].sum(),
                "saved": (self.suffix[first, 0] + self.after[first] - fresh[first]).sum(),
            }
            yield self._batch(PART, depth=[0], k1=[0], k2=[0], **{k: [int(v)] for k, v in own.items()})
            ended = first & (self.size == 0)
            if ended.any():
                zero = np.zeros(int(ended.sum()), np.int64)
                yield self._batch(END, depth=zero, k1=zero, k2=zero, conv=self.conv[ended])
        over, over_min, over_part = None, None, None
        for j in range(self.width):
            v = self.valid[:, j]
            begins = np.flatnonzero(self.start[:, j])
            goes_on = bool(v[0]) and not self.up[0, j]
            if goes_on:
                begins = np.concatenate([[0], begins])
            if not len(begins):
                return
            total = lambda x: np.add.reduceat(np.where(v, x, 0), begins)  # noqa: E731, B023
            part = np.zeros(len(begins), bool)
            part[0] |= goes_on
            part[-1] |= bool(v[n - 1]) and not self.down[n - 1, j]
            least = np.minimum.reduceat(np.where(v, self.conv, np.iinfo(np.int64).max), begins)
            children = self.start[:, j + 1] if j + 1 < self.width else self.next_starts * self.more if j + 1 == width else np.zeros(n, np.int64)
            # A node's first row starts it at this column, whatever it starts before.
            here = np.where(part & (np.arange(len(begins)) == 0) & goes_on, 0, self.suffix[begins, j] - self.new[begins])
            columns = {
                "depth": self.panel[begins] * width + j + 1, "k1": self.x1[begins, j], "k2": self.x2[begins, j], "conv": least, "n_convs": total(1),
                "n_children": total(children), "n_leaves": total(weight), "saved": total(self.suffix[:, j] + self.after) - total(fresh) - here,
            }
            if j:
                parent = np.searchsorted(over, begins, "right") - 1
                known = ~over_part[parent] & ~part
                columns |= {"up1": self.x1[begins, j - 1], "up2": self.x2[begins, j - 1], "parent": over_min[parent]}
            else:
                known = np.zeros(len(begins), bool)
                columns |= {"up1": self.b1[begins], "up2": self.b2[begins], "parent": np.zeros(len(begins), np.int64)}
            masks = {"up1": known, "up2": known, "parent": ~known}
            ended = np.flatnonzero(v & (self.size == j + 1) & ~self.more)
            owner = np.searchsorted(begins, ended, "right") - 1
            hashes = np.full(len(begins), EMPTY, object)
            for node, low, high in self._runs(owner):
                if not part[node]:
                    hashes[node] = hashlib.sha256(",".join(map(str, self.conv[ended[low:high]].tolist())).encode()).hexdigest()
            for kind, chosen in ((FINAL, ~part), (PART, part)):
                if chosen.any():
                    yield self._batch(kind, {k: m[chosen] for k, m in masks.items()}, ends=hashes[chosen] if kind == FINAL else None, **{k: c[chosen] for k, c in columns.items()})
            crossing = part[owner]
            if crossing.any():
                at, rows = owner[crossing], ended[crossing]
                yield self._batch(END, depth=columns["depth"][at], k1=columns["k1"][at], k2=columns["k2"][at], conv=self.conv[rows])
            over, over_min, over_part = begins, least, part

    @staticmethod
    def _runs(owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        if len(owner):
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield int(owner[low]), low, high

    @staticmethod
    def _batch(kind: int, masks: dict | None = None, **columns) -> pa.RecordBatch:
        size = len(columns["depth"])
        names = [f.split()[0] for f in _NODE.split(", ")]
        out = [pa.array(np.full(size, kind), pa.int32())]
        for name in names[1:]:
            values = columns.get(name)
            type_ = pa.string() if name == "ends" else pa.int64()
            out.append(pa.nulls(size, type_) if values is None else pa.array(values, type_, mask=(masks or {}).get(name)) if (masks or {}).get(name) is not None else pa.array(values, type_))
        return pa.RecordBatch.from_arrays(out, names=names)


_COLUMNS = ("panel", "b1", "b2", "conv", "ids", "words", "after", "more", "deep_words", "deep_leaf", "next_starts")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, tuple]]:
    """(part, kind, row for a slice)."""
    part, kind, panel, b1, b2, conv, ids, words, *rest = batch.columns
    inner, offsets = ids.flatten(), ids.offsets.to_numpy()
    offsets = offsets - offsets[0]
    k1, k2 = inner.field(0).to_numpy(), inner.field(1).to_numpy()
    fields = [c.to_pylist() for c in (part, kind, panel, b1, b2, conv, words, *rest)]
    for i, (a, k, p, x, y, c, w, *more) in enumerate(zip(*fields, strict=True)):
        own = slice(offsets[i], offsets[i + 1])
        yield a, k, (p, x, y, c, k1[own], k2[own], w, *more)


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[tuple], tuple | None, tuple | None]]:
    """(rows, row before, row behind): runs of a part's rows in order."""
    part, before, rows = None, None, []
    for batch in batches:
        for at, kind, row in _rows(batch):
            if at != part:
                if rows:
                    yield rows, before, None
                part, before, rows = at, None, []
            if kind < 0:
                before = row
            elif kind > 0 or len(rows) == size:
                if rows:
                    yield rows, before, row
                    before = rows[-1]
                rows = [] if kind > 0 else [row]
            else:
                rows.append(row)
    if rows:
        yield rows, before, None


def _dealt(found: DataFrame) -> DataFrame:
    """Panels by ranges in order, each range with the row before and the row behind it."""
    order = ("panel", "b1", "b2", "ids", "more", "conv")
    ranged = found.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    shards = common.stored(ranged, "trie-shards")
    ends = shards.groupBy("part").agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"))
    # A row per range.
    line = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(line).alias("before"), F.lead("first").over(line).alias("behind"))
    both = F.array(F.struct(F.lit(-1).alias("kind"), F.col("before").alias("row")), F.struct(F.lit(1).alias("kind"), F.col("behind").alias("row")))
    guests = ends.select("part", F.inline(both)).where("row IS NOT NULL").select("part", "kind", "row.*")
    return shards.withColumn("kind", F.lit(0)).unionByName(guests, allowMissingColumns=True)


def nodes(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", width: int = WIDTH, slice_rows: int = SLICE) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    NULL and empty roles and texts are the same. Turns of one number, repeated rows
    among them, follow each other by the hash of role and text. Rows without a
    conv_id belong to no conversation. A conversation left without turns is a member
    of the root. An empty table has no conversation, so no root, and gives no rows.
    """
    made = _dealt(panels(*rebuilt(turns(rows, conv, turn, role, text)), width))
    long = made.where((F.col("panel") > 0) & (F.col("kind") == 0))
    zero = {n: F.lit(0).cast("bigint") for n in ("deep_words", "deep_leaf", "next_starts")}

    def dealt(df: DataFrame) -> DataFrame:
        columns = df.select("part", "kind", *_COLUMNS).repartition("part")
        return columns.sortWithinPartitions("part", "kind", "panel", "b1", "b2", "ids", "more", "conv")

    if long.isEmpty():
        full = made.withColumns(zero)
    else:
        # What later panels tell of their conversation, for the nodes above them.
        def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, before, behind in _slices(batches, slice_rows):
                yield _Slice(own, width, before, behind).attributed()

        told = dealt(made.withColumns(zero)).mapInArrow(attribute, "conv long, panel long, own_words long, leaf long, starts long")
        told = common.stored(told, "trie-attributed")
        # The panel before each takes part, with nothing of its own if it is the first.
        above = told.where("panel = 1").select("conv", F.lit(0).cast("bigint").alias("panel"))
        for name in ("own_words", "leaf", "starts"):
            above = above.withColumn(name, F.lit(0).cast("bigint"))
        deep = _beyond(told.unionByName(above), {"deep_words": (F.sum, "own_words"), "deep_leaf": (F.sum, "leaf")}, True)
        below = told.select("conv", (F.col("panel") - 1).alias("panel"), F.col("starts").alias("next_starts"))
        deep = common.stored(deep.select("conv", "panel", "deep_words", "deep_leaf").join(below, ["conv", "panel"], "left"), "trie-deep")
        filled = {n: F.coalesce(F.col(n), F.lit(0)) for n in zero}
        full = made.join(deep, ["conv", "panel"], "left").withColumns(filled)

    def aggregate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, before, behind in _slices(batches, slice_rows):
            yield from _Slice(own, width, before, behind).nodes(width)

    found = common.stored(dealt(full).mapInArrow(aggregate, _NODE), "trie-nodes")
    key = ["depth", "k1", "k2"]
    parts = found.where(F.col("kind") == PART).groupBy(*key).agg(
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in _SUMS], F.first("up1").alias("up1"), F.first("up2").alias("up2")
    )
    whole = parts.join(_ends(found.where(F.col("kind") == END).select(*key, "conv")), key, "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY)))
    whole = common.stored(whole, "trie-crossing")
    final = found.where(F.col("kind") == FINAL)
    known = whole.select(*key, "conv").unionByName(final.where(F.col("depth") % width == 0).select(*key, "conv"))
    known = common.stored(known.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv").alias("above")), "trie-parents")
    columns = ["conv", "depth", *_SUMS, "ends"]
    asking = final.where("parent IS NULL").select(*columns, "up1", "up2").unionByName(whole.select(*columns, "up1", "up2"))
    answered = asking.join(known, ["depth", "up1", "up2"], "left").select(*columns, F.col("above").alias("parent"))
    return answered.unionByName(final.where("parent IS NOT NULL").select(*columns, "parent")).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends): the hash of each node's ids in order, as they stream by."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            cuts = np.append(np.flatnonzero(new), batch.num_rows)
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = tuple(int(c[low]) for c in columns[:3])
                text = ",".join(map(str, columns[3][low:high].tolist())).encode()
                if key == last:
                    state.update(b"," + text)
                else:
                    if state is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256(text)
        if state is not None:
            done.append((*last, state.hexdigest()))
        parts = list(zip(*done, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([*(pa.array(p, pa.int64()) for p in parts[:3]), pa.array(parts[3], pa.string())], names=["depth", "k1", "k2", "ends"])

    return rows.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "conv").mapInArrow(task, "depth long, k1 long, k2 long, ends string")
