"""Remove byte strings that occur elsewhere, by the intervals of an enhanced suffix array.

The suffix array is sparse and cut where no long repeat can cross: its suffixes begin
at anchors (see `anchors`), and suffixes with different anchors share too little.
Suffixes of equal contexts are one entry with a count. Spark partitions the entries
by anchor and sorts them by what follows the anchor; each task walks its stretch of
the array once, keeping the longest-common-prefix intervals on a stack. The members
of an interval share their right side. Sorted by their left side, they fall into
classes that share enough on the left to fill the wanted length; the least common
prefix of neighbours says where the left sides part, so every class is a maximal
repeat with all its occurrences.

An anchor with more than `MOST_VARIANTS` different contexts (the edge of a passage
that a large part of the corpus quotes) is no task's to hold: for these, windows are
counted by content, which Spark can split at will, and so are prefixes for groups of
repeats. The answer is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from . import anchors, common

LENGTH = 400
#: Half of the window: the longer, the fewer chance anchors, the shorter, the fewer anchors.
GRAM = 200
UNIT = anchors.Unit(anchors.byte_symbols, LENGTH, GRAM)
MOST_VARIANTS = 4096
#: Rows a task hands on at once.
MOST_ROWS = 20000

_ENTRY = "anchor long, context long, copies long, left binary, right binary"
_REPEAT = "anchor long, context long, ahead int, behind int, repeat long"
_MARK = "anchor long, context long, behind boolean, length int, prefix binary, following int"


def _entries(docs: DataFrame, different: DataFrame, unit: anchors.Unit) -> DataFrame:
    """Suffixes: the bytes before the anchor, last first, and those after it, within the context."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, places in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: dict[str, list] = {n: [] for n in ("anchor", "context", "copies", "left", "right")}
                for place in places:
                    at = place["at"]
                    for name in ("anchor", "context", "copies"):
                        out[name].append(place[name])
                    out["left"].append(text[place["first"] : at][::-1])
                    out["right"].append(text[at + unit.gram : place["last"] + unit.window])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], pa.binary() if n in ("left", "right") else pa.int64()) for n in out], names=list(out)
                )

    return anchors.with_texts(docs, different).mapInArrow(task, _ENTRY)


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


def intervals(shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """(least, from, to) of the common-prefix intervals of a sorted array, inner ones first.

    `shared[i]` is the common prefix of entries i and i + 1; an interval's entries are from .. to - 1.
    """
    stack: list[tuple[int, int]] = []
    for i, now in enumerate([*shared, -1]):
        begin = i
        while stack and stack[-1][0] > now:
            least, begin = stack.pop()
            yield least, begin, i + 1
        if not stack or stack[-1][0] < now:
            stack.append((now, begin))


def classes(lefts: list[bytes], rights: list[bytes], wanted: int) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Maximal repeats among entries sorted by `rights`.

    (right, left, members, ahead): the members share `right` bytes behind and `left`
    bytes before the anchor, `wanted` together or more; `ahead` is how much each
    shares with the nearest other member.
    """
    shared = [_common(a, b) for a, b in zip(rights, rights[1:], strict=False)]
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    place = {entry: i for i, entry in enumerate(order)}
    for right, begin, end in intervals(shared):
        need = max(wanted - right, 0)
        ranked = sorted(range(begin, end), key=place.__getitem__)
        ties = [_common(lefts[a], lefts[b]) for a, b in zip(ranked, ranked[1:], strict=False)]
        start = 0
        for i, tie in enumerate([*ties, -1]):
            if tie < need:
                if i > start:
                    inner = ties[start:i]
                    nearest = [max(x, y) for x, y in zip([0, *inner], [*inner, 0], strict=True)]
                    yield right, min(inner), ranked[start : i + 1], nearest
                start = i + 1


def maximal(lefts: list[bytes], rights: list[bytes], wanted: int) -> Iterator[tuple[int, int, list[int]]]:
    """(right, left, members) of all maximal repeats of `wanted` or more among entries sorted by `rights`.

    The members of an interval are put in order of their left sides; the intervals of that
    order part where a left extension differs. What the first and the last member share
    behind the anchor tells whether the right extension differs too.
    """
    shared = [_common(a, b) for a, b in zip(rights, rights[1:], strict=False)]
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    place = {entry: i for i, entry in enumerate(order)}
    for right, begin, end in intervals(shared):
        ranked = sorted(range(begin, end), key=place.__getitem__)
        ties = [_common(lefts[a], lefts[b]) for a, b in zip(ranked, ranked[1:], strict=False)]
        for left, low, high in intervals(ties):
            if left + right >= wanted:
                members = ranked[low:high]
                if _common(rights[min(members)], rights[max(members)]) == right:
                    yield right, left, members


def _walk(entries: DataFrame, unit: anchors.Unit, grouped: bool = False) -> DataFrame:
    """What each context shares with others of its anchor.

    One row per context, with the most that any class shares behind the anchor and the
    most that another member of a class shares ahead of it; or, grouped, a row per maximal
    repeat and member.
    """
    wanted = unit.window - unit.gram

    def widest(anchor: int, own: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, int, int, int, int]]:
        most: dict[int, tuple[int, int]] = {}
        for right, _, members, ahead in classes([x[1] for x in own], [x[2] for x in own], wanted):
            for member, left in zip(members, ahead, strict=True):
                known = most.get(member, (0, 0))
                most[member] = max(known[0], left), max(known[1], right)
        for member, (left, right) in most.items():
            yield anchor, own[member][0], left, right, 0

    def groups(anchor: int, own: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, int, int, int, int]]:
        for number, (right, left, members) in enumerate(maximal([x[1] for x in own], [x[2] for x in own], wanted)):
            for member in members:
                yield anchor, own[member][0], left, right, number

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
        own: list[tuple[int, bytes, bytes]] = []
        last = None
        for batch in batches:
            for anchor, context, left, right in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if anchor != last and own:
                    yield last, own
                    own = []
                last = anchor
                own.append((context, left, right))
        if own:
            yield last, own

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        names = ["anchor", "context", "ahead", "behind", "repeat"]
        found = (row for anchor, own in runs(batches) for row in (groups if grouped else widest)(anchor, own))
        while some := list(islice(found, MOST_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

    return entries.repartition("anchor").sortWithinPartitions("anchor", "right", "left").mapInArrow(task, _REPEAT)


def _marks(entries: DataFrame) -> DataFrame:
    """A row per context, side and length: the prefix of that side, and the byte that follows it (-1: nothing)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for anchor, context, *sides in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                for behind, side in zip((False, True), sides, strict=True):
                    for n in range(len(side) + 1):
                        prefix = hashlib.blake2b(side[:n], digest_size=16).digest()
                        yield anchor, context, behind, n, prefix, side[n] if n < len(side) else -1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int32())
        names = ["anchor", "context", "behind", "length", "prefix", "following"]
        found = rows(batches)
        while some := list(islice(found, MOST_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

    return entries.mapInArrow(task, _MARK)


def _crowded_groups(docs: DataFrame, crowded: DataFrame, unit: anchors.Unit) -> DataFrame:
    """The grouped rows of `_walk` for anchors that no task holds.

    An interval is a prefix that is followed by different bytes, or ends; it is a group by
    content, which Spark counts map-side first. A maximal repeat is an interval on either
    side, shared by two contexts or more that differ beyond it on both sides.
    """
    wanted = unit.window - unit.gram
    differ = "n > 1 AND (low <> high OR high = -1)"
    marks = common.stored(_marks(_entries(docs, crowded, unit)), "marks")
    prefix = ["anchor", "behind", "length", "prefix"]
    low, high, n = F.min("following").alias("low"), F.max("following").alias("high"), F.count(F.lit(1)).alias("n")
    ends = marks.groupBy(*prefix).agg(n, low, high).where(differ)
    kept = common.stored(marks.join(ends, prefix, "left_semi"), "intervals")

    def side(behind: bool, *names: str) -> DataFrame:
        return kept.where(F.col("behind") == behind).select("anchor", "context", *[F.col(c).alias(a) for c, a in zip(("length", "prefix", "following"), names, strict=True)])

    both = side(False, "ahead", "_left", "_before").join(side(True, "behind", "_right", "_after"), ["anchor", "context"])
    both = common.stored(both.where(F.col("ahead") + F.col("behind") >= wanted), "sides")
    repeat = ["anchor", "ahead", "behind", "_left", "_right"]
    groups = (
        both.groupBy(*repeat)
        .agg(n, *[f(c).alias(f"{a}{c}") for c in ("_before", "_after") for f, a in ((F.min, "low"), (F.max, "high"))])
        .where("n > 1 AND (low_before <> high_before OR high_before = -1) AND (low_after <> high_after OR high_after = -1)")
    )
    number = F.xxhash64(*repeat[1:]).alias("repeat")
    return both.join(groups.select(*repeat), repeat).select("anchor", "context", "ahead", "behind", number)


def _variants(docs: DataFrame, unit: anchors.Unit) -> tuple[DataFrame, DataFrame]:
    found = common.stored(anchors.rows(docs, unit), "suffixes")
    return found, common.stored(anchors.contexts(found), "variants")


def _compared(docs: DataFrame, different: DataFrame, unit: anchors.Unit, most: int, grouped: bool = False) -> DataFrame:
    return _walk(_entries(docs, different.where((F.col("variants") > 1) & (F.col("variants") <= most)), unit), unit, grouped)


def repeated_spans(docs: DataFrame, unit: anchors.Unit = UNIT, most: int = MOST_VARIANTS) -> DataFrame:
    """(id, key, text, spans) for rows (id, key, text): the bytes in strings of `unit.window` that occur elsewhere."""
    found, different = _variants(docs, unit)
    # An entry's repeats all hold its anchor, so they cover one stretch.
    back = F.lit(unit.window - unit.gram) - F.max("behind")
    near = _compared(docs, different, unit, most).groupBy("anchor", "context").agg(F.max("ahead").alias("ahead"), back.alias("back"))
    crowded = anchors.repeated_windows(docs, different.where(F.col("variants") > most), unit)
    outer = anchors.whole(different.where("variants = 1")).unionByName(crowded)
    # Equal contexts occur as a whole; their entry also stands for its other copies.
    kept = anchors.whole(different.where((F.col("variants") > 1) & (F.col("variants") <= most)))
    both = near.unionByName(kept).groupBy("anchor", "context").agg(F.max("ahead").alias("ahead"), F.min("back").alias("back"))
    return anchors.covered(docs, found, outer.unionByName(both), unit.window)


def maximal_repeats(docs: DataFrame, identity: str = "doc_id", text: str = "text", unit: anchors.Unit = UNIT, most: int = MOST_VARIANTS) -> DataFrame:
    """(anchor, repeat, id, start, length): all occurrences of each maximal repeat.

    A repeat is told by anchor and number; one that is longer than a context is
    shown in several overlapping parts, one for each anchor. A group is
    all occurrences of a string that is followed, and preceded, by different bytes.
    Anchors with more than `most` different contexts give the same groups, found by
    content instead of in one task. Contexts that occur twice are a group of their own.
    NULL and empty texts, and an empty table, have no repeats.
    """
    rows = anchors.identified(docs, identity, text)
    found, different = _variants(rows, unit)
    single = different.where("copies > 1").select(
        "anchor", "context", (F.col("at") - F.col("first")).alias("ahead"), (F.col("last") + unit.window - F.col("at") - unit.gram).alias("behind"), F.lit(None).cast("long").alias("repeat")
    )
    walked = _compared(rows, different, unit, most, grouped=True)
    crowded = _crowded_groups(rows, different.where(F.col("variants") > most), unit)
    groups = walked.unionByName(crowded).unionByName(single)
    return found.join(groups, ["anchor", "context"]).select(
        "anchor", F.coalesce("repeat", "context").alias("repeat"), F.col("id").alias(identity),
        (F.col("at") - F.col("ahead")).alias("start"), (F.col("ahead") + F.col("behind") + unit.gram).alias("length"),
    )


def kept_bytes(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    NULL and empty texts have no bytes, and the hash of nothing. Repeated rows are
    elsewhere for each other. Texts shorter than the length stay whole. An empty
    table gives no rows.
    """
    rows = repeated_spans(anchors.identified(docs, identity, text))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for content, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                content, pieces, end, gone, runs = content or b"", [], 0, 0, 0
                for low, high in sorted((s["from"], s["to"]) for s in spans or ()):
                    if low > end or not runs:
                        pieces.append(content[end:low])
                        runs += 1
                        gone += high - low
                    else:
                        gone += max(0, high - end)
                    end = max(end, high)
                pieces.append(content[end:])
                out.append((len(content), gone, runs, hashlib.sha256(b"".join(pieces)).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=[identity, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    counts = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([T.StructField(identity, anchors.id_type(rows)), *counts, T.StructField("kept_sha256", T.StringType())])
    return rows.select("id", "text", "spans").mapInArrow(task, schema)
