"""A Merkle manifest of a data set as a postorder append log.

Every group (source) is a tree of sixteenfold runs over its ordered leaves, and the
roots of the groups are the leaves of one more tree. A log holds the nodes of a tree
in the order in which they are completed: leaf i comes after the i leaves before it
and the i // 16 + i // 256 + ... inner nodes that these complete, and a node comes
right after the last leaf it covers and the lower nodes that end there. So a node's
position follows from the sizes of the subtrees before it, no index is kept, and
siblings are addressed by arithmetic.

A builder takes an aligned run of 16^3 leaves, which no node of its three levels
crosses, and appends their nodes to the log. The builders' roots are the leaves of
the next stage, so a tree of n leaves takes log n / log 4096 stages of Spark jobs. A
proof is read off the same way from the top: every builder's segment adds the siblings
of its three levels to what the segment above has told.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common, ranking

#: Nodes that become one, and levels that one builder completes.
FAN, LEVELS = 16, 3
HASH = 32
#: Files of tables with a row per segment.
FILES = 64

_STEP = T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("others", T.BinaryType())]))


def height(leaves: int) -> int:
    """Levels above the leaves, until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def position(level: int, index, leaves: int):
    """Where the log of a tree holds node `index` of `level`, the leaves being level 0."""
    last = np.minimum((np.asarray(index, np.int64) + 1) * FAN**level, leaves) - 1
    before, width = last.copy(), FAN
    while width <= leaves:
        before += last // width
        width *= FAN
    return before + level


def _digest(parts: bytes) -> bytes:
    return hashlib.sha256(parts).digest()


def appended(leaves: list[bytes], levels: int) -> bytes:
    """The log of a run of leaves, nodes as they are completed, up to `levels` above."""
    log, open_ = [], [[] for _ in range(levels + 1)]

    def complete(level: int) -> None:
        node = _digest("".join(x.hex() for x in open_[level]).encode())
        open_[level].clear()
        log.append(node)
        open_[level + 1].append(node)

    for leaf in leaves:
        log.append(leaf)
        open_[0].append(leaf)
        for level in range(levels):
            if len(open_[level]) < FAN:
                break
            complete(level)
    for level in range(levels):
        if open_[level]:
            complete(level)
    return b"".join(log)


def siblings(log: bytes, leaves: int, levels: int) -> list[list[tuple[int, bytes]]]:
    """For each leaf of a run and each level, the place among the siblings and these."""
    nodes = [log[i : i + HASH] for i in range(0, len(log), HASH)]
    levelled: list[list[tuple[int, bytes]]] = []
    for level in range(levels):
        count = -(-leaves // FAN**level)
        row = [nodes[p] for p in position(level, np.arange(count), leaves).tolist()]
        levelled.append([(i % FAN, b"".join(row[i - i % FAN : i] + row[i + 1 : i - i % FAN + FAN])) for i in range(count)])
    return [[levelled[level][i // FAN**level] for level in range(levels)] for i in range(leaves)]


def folded(leaf: bytes, steps) -> bytes:
    """The root that a leaf and its siblings, level by level, lead to."""
    for place, others in steps:
        text = others.hex()
        cut = 2 * HASH * place
        leaf = _digest((text[:cut] + leaf.hex() + text[cut:]).encode())
    return leaf


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first columns."""
    last, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != last:
                if rows:
                    yield last, rows
                last, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield last, rows


def _levels_of(leaves: int, block_leaves: int) -> int:
    """Levels that a builder completes: all of a tree that it has whole, else its three."""
    return height(block_leaves) if leaves <= FAN**LEVELS else LEVELS


def segments(leaves: DataFrame) -> DataFrame:
    """(tree, block, leaves, n, log, ids, changed) from rows (tree, at, leaves, digest, id, changed).

    A row per builder: `log` holds the nodes of its run in order of completion,
    `leaves` how many leaves the whole stage of that tree has, `n` those of the run.
    """
    key, kind = leaves.schema["tree"], leaves.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("tree", key.dataType), T.StructField("block", T.LongType()), T.StructField("leaves", T.LongType()),
         T.StructField("n", T.IntegerType()), T.StructField("log", T.BinaryType()), T.StructField("ids", T.ArrayType(kind)),
         T.StructField("changed", T.ArrayType(T.BinaryType()))]
    )
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _grouped(batches, 2):
            _, total, digests, ids, changed = zip(*rows, strict=True)
            log = appended(digests, _levels_of(total[0], len(rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip((tree, block, total[0], len(rows), log, list(ids), list(changed)), arrow, strict=True)], schema=arrow
            )

    block = F.shiftright("at", (FAN**LEVELS).bit_length() - 1).alias("block")
    dealt = leaves.select("tree", block, "at", "leaves", "digest", "id", "changed").repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.mapInArrow(task, schema)


def _tops(built: DataFrame) -> DataFrame:
    """(tree, block, leaves, digest) of the last node of each segment, its root."""
    return built.select("tree", "block", "leaves", F.expr(f"substring(log, -{HASH}, {HASH})").alias("digest"))


def stages(leaves: DataFrame, purpose: str) -> list[DataFrame]:
    """The written segments of all trees, stage by stage, the leaves' first.

    A stage holds the trees that have more than one segment in the stage before.
    """
    found = [common.stored(segments(leaves), purpose)]
    while True:
        most = found[-1].agg(F.max("leaves")).first()[0] or 0
        if most <= FAN**LEVELS:
            return found
        upper = _tops(found[-1]).where(F.col("leaves") > FAN**LEVELS).select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("leaves") / FAN**LEVELS).cast("bigint").alias("leaves"),
            "digest", F.lit(None).cast(leaves.schema["id"].dataType).alias("id"), F.lit(None).cast("binary").alias("changed"),
        )
        found.append(common.stored(segments(upper), purpose, FILES))


def roots(built: list[DataFrame]) -> DataFrame:
    """(tree, digest): the root of every tree."""
    tops = [_tops(b).where(F.col("leaves") <= FAN**LEVELS).select("tree", "digest") for b in built]
    first, *rest = tops
    for other in rest:
        first = first.unionByName(other)
    return first


def nodes(built: list[DataFrame]) -> DataFrame:
    """(tree, position, level, index, digest): the whole log of every tree, a row per node."""

    def task(stage: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, block, leaves, n, log, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    # Roots of lower segments are in the log already.
                    for level in range(1 if stage else 0, _levels_of(leaves, n) + 1):
                        own = position(level, np.arange(-(-n // FAN**level)), n)
                        index = np.arange(len(own)) + block * FAN ** (LEVELS - level)
                        whole = stage * LEVELS + level
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree] * len(index), batch.schema.field(0).type), pa.array(position(whole, index, total)), pa.array([whole] * len(index), pa.int32()),
                             pa.array(index), pa.array([log[p * HASH : p * HASH + HASH] for p in own.tolist()], pa.binary())],
                            names=["tree", "position", "level", "index", "digest"],
                        )

        return run

    sizes = built[0].groupBy("tree").agg(F.max("leaves").alias("total"))
    kinds = {"position": T.LongType(), "level": T.IntegerType(), "index": T.LongType(), "digest": T.BinaryType()}
    schema = T.StructType([built[0].schema["tree"], *[T.StructField(n, k) for n, k in kinds.items()]])
    out = None
    for stage, one in enumerate(built):
        rows = one.alias("b").join(sizes.alias("s"), F.expr("b.tree <=> s.tree")).select("b.tree", "block", "leaves", "n", "log", "total")
        rows = rows.mapInArrow(task(stage), schema)
        out = rows if out is None else out.unionByName(rows)
    return out


def _below(built: DataFrame, told: DataFrame) -> DataFrame:
    """(tree, at, steps) for every leaf of a stage: its siblings up to the root of all.

    `told` has (tree, at, steps) for the segments themselves.
    """
    schema = T.StructType([built.schema["tree"], T.StructField("at", T.LongType()), T.StructField("steps", _STEP)])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, leaves, n, log, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = siblings(log, n, _levels_of(leaves, n))
                for a in range(0, n, 256):
                    some = [[*({"place": p, "others": o} for p, o in x), *steps] for x in own[a : a + 256]]
                    at = [block * FAN**LEVELS + a + i for i in range(len(some))]
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([tree] * len(at), at, some), arrow, strict=True)], schema=arrow)

    return _met(built, told).mapInArrow(task, schema)


def _met(built: DataFrame, told: DataFrame) -> DataFrame:
    on = F.expr("b.tree <=> t.tree AND b.block = t.at")
    return built.alias("b").join(told.alias("t"), on).select("b.tree", "block", "leaves", "n", "log", "steps")


def _told(built: list[DataFrame], top: DataFrame) -> DataFrame:
    """(tree, at, steps) for the segments of the first stage, from `top` (tree, steps)."""
    told = None
    for one in reversed(built):
        # Trees whose last stage this is begin here.
        begun = one.where(F.col("leaves") <= FAN**LEVELS).alias("b").join(top.alias("t"), F.expr("b.tree <=> t.tree"))
        begun = begun.select("b.tree", F.col("block").alias("at"), "steps")
        told = begun if told is None else told.unionByName(begun)
        if one is not built[0]:
            told = common.stored(_below(one, told), "merkle-steps", FILES)
    return told


def leaf(columns: list[Column]) -> Column:
    """The hash of values by length, so that no two rows read the same; NULL is `-`."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def lowered(text: Column) -> Column:
    """A-Z as a-z, all else as it was."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The log of every group and of the groups' roots, from rows (tree, id, digest, changed).

    Leaves of a tree ascend by id, NULL first, equal ids by digest. `changed` is
    another digest that is carried along, NULL for none.
    """
    placed = common.stored(ranking.ranked(leaves, "tree", ["id", "digest"]), "merkle-leaves")
    sizes = placed.groupBy(F.col("tree").alias("t")).agg(F.count(F.lit(1)).alias("leaves"))
    groups = stages(placed.join(sizes, F.col("tree").eqNullSafe(F.col("t"))).drop("t"), "merkle-log")
    # A constant tree over the groups, which ascend by name, NULL first.
    every = ranking.ranked(roots(groups).select(F.lit(0).alias("all"), F.col("tree").alias("id"), "digest"), "all", ["id"])
    every = common.stored(every, "merkle-roots", FILES)
    count = every.count()
    whole = every.select(F.col("all").alias("tree"), "at", F.lit(count).cast("bigint").alias("leaves"), "digest", "id", F.lit(None).cast("binary").alias("changed"))
    return groups, stages(whole, "merkle-top")


def proofs(groups: list[DataFrame], top: list[DataFrame]) -> DataFrame:
    """(tree, id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    The siblings come from the logs; the folded root is worked out from `changed`
    where a leaf has it, else from the leaf itself.
    """
    # One row, or none for an empty table.
    whole = roots(top).first()
    begin = top[-1].select("tree", F.array().cast(_STEP).alias("steps"))
    # The segments of the top tree hold the groups as ids.
    lead = _told(top, begin.dropDuplicates(["tree"]))
    above = _below(top[0], lead).alias("s")
    named = top[0].select("block", F.posexplode("ids").alias("i", "id")).select((F.col("block") * FAN**LEVELS + F.col("i")).alias("at"), "id").alias("n")
    steps = common.stored(above.join(named, F.expr("s.at = n.at")).select(F.col("id").alias("tree"), "steps"), "merkle-steps", FILES)
    told = _told(groups, steps)
    subroots = roots(groups).withColumnRenamed("digest", "subroot")
    heads = told.alias("t").join(subroots.alias("r"), F.expr("t.tree <=> r.tree")).select("t.*", "subroot")
    on = F.expr("b.tree <=> t.tree AND b.block = t.at")
    met = groups[0].alias("b").join(common.stored(heads, "merkle-heads", FILES).alias("t"), on)
    met = met.select("b.tree", "b.leaves", "b.n", "b.log", "b.ids", "b.changed", "t.steps", "t.subroot")
    texts = [T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = T.StructType([groups[0].schema["tree"], T.StructField("id", groups[0].schema["ids"].dataType.elementType), *texts, T.StructField("verified", T.BooleanType())])
    arrow, root = to_arrow_schema(schema), bytes(whole["digest"]) if whole else b""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, leaves, n, log, ids, changed, steps, subroot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                levels = _levels_of(leaves, n)
                own = siblings(log, n, levels)
                first = position(0, np.arange(n), n).tolist() if levels else [0]
                later = [(s["place"], s["others"]) for s in steps]
                rest = "".join(o.hex() for _, o in later).encode()
                out = []
                for i in range(n):
                    now = log[first[i] * HASH : first[i] * HASH + HASH]
                    proof = hashlib.sha256("".join(o.hex() for _, o in own[i]).encode() + rest).hexdigest()
                    end = folded(folded(changed[i] or now, own[i]), later)
                    out.append((tree, ids[i], now.hex(), subroot.hex(), root.hex(), proof, end.hex(), end == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return met.mapInArrow(task, schema)


def tampered(identity: Column, every: int = 5) -> Column:
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % every == 0, F.lit(False))


def verify(docs: DataFrame, identity: str = "doc_id", group: str = "source", columns=("doc_id", "source", "lang", "n_chars", "text"), text: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    The trees are those of the given rows; the documents whose number's crc32 is
    divisible by 5 are then held against them with their text in lower case. NULL is
    hashed as `-`, a NULL source is a source and the first one, NULL ids come first in
    theirs and are never changed; repeated rows are leaves of their own, side by side.
    An empty table has no tree and gives no rows.
    """
    quoted = {c: F.col(f"`{c}`") for c in columns}
    other = leaf([lowered(quoted[c]) if c == text else quoted[c] for c in columns])
    rows = docs.select(
        F.col(f"`{group}`").alias("tree"), F.col(f"`{identity}`").alias("id"), leaf(list(quoted.values())).alias("digest"),
        F.when(tampered(F.col(f"`{identity}`")), other).alias("changed"),
    )
    return proofs(*manifest(rows)).drop("tree").withColumnRenamed("id", identity)
