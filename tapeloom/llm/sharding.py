"""Shards of bounded bytes by extendible hashing.

The directory is the tree of hash prefixes. A bucket that is larger than the limit
is split on its next bit, the others stay as they are, so a shard is the shortest
prefix of its rows' hash under which they fit. All prefixes of up to `BITS` more
bits are weighed in one pass over a histogram of the longest; only rows of buckets
that are too large even then go on to the next pass.

The first 60 bits come from the row's id, so a document's shard is known from its
id; rows that agree in all of them (repeated ids) are told apart by 60 bits more,
from their place in the input. A row larger than the limit ends as a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import common

LIMIT = 128 << 20
#: Bits per pass; a histogram has 2**BITS cells at most for each bucket that is too large.
BITS = 15
KEY_BITS = 60


def key_bits(value: Column) -> Column:
    """60 bits of the value's text as a bigint; NULL counts as empty."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _node(key: Column, depth: Column | int) -> Column:
    """The first `depth` bits of a key behind a 1, so that prefixes of all lengths differ."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), depth)
    return one + F.call_function("shiftright", key, F.lit(KEY_BITS) - depth)


def _pass(rows: DataFrame, key: str, low: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their shard, rows that stay too large) after weighing the prefixes of `low` to `low + BITS` bits.

    Rows are (row, id, first, second, bytes, bucket): `bucket` names what the key is a part of.
    """
    high = low + BITS
    cells = rows.groupBy("bucket", _node(F.col(key), high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    cells = common.stored(cells, "sharding-cells")
    depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
    depths = depths.withColumn("node", F.call_function("shiftright", F.col("cell"), F.lit(high) - F.col("depth")))
    nodes = depths.groupBy("bucket", "depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("n"))
    fitting = nodes.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1)).drop("n")
    placed = depths.select("bucket", "cell", "depth", "node").join(fitting, ["bucket", "depth", "node"])
    found = placed.groupBy("bucket", "cell").agg(F.min(F.struct("depth", "node", "shard_bytes")).alias("shard"))
    found = common.stored(found, "sharding-directory")
    joined = rows.withColumn("cell", _node(F.col(key), high)).join(found, ["bucket", "cell"], "left")
    return joined.where("shard IS NOT NULL"), joined.where("shard IS NULL").select(*rows.columns)


def assign(docs: DataFrame, identity: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, bytes, shard_id, overflow, depth, shard_bytes) of every document.

    `shard_id` is the shard's prefix behind a 1 bit, `depth` its length. `overflow`
    is 0, or for rows whose ids agree in 60 bits the same for the other key. NULL and
    empty texts have no bytes. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{identity}`").alias("id"),
        key_bits(F.col(f"`{identity}`")).alias("first"),
        key_bits(F.monotonically_increasing_id()).alias("second"),
        F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint").alias("bytes"),
    )
    rows = common.stored(rows, "sharding-rows").withColumn("bucket", F.lit(0).cast("bigint"))
    out = None
    for key in ("first", "second"):
        for low in range(0, KEY_BITS, BITS):
            done, rows = _pass(rows, key, low, limit)
            overflow = F.lit(0).cast("bigint") if key == "first" else F.col("shard.node")
            shard = F.col("shard.node") if key == "first" else F.col("bucket")
            depth = F.col("shard.depth") + (0 if key == "first" else KEY_BITS)
            done = done.select(F.col("id").alias(identity), "bytes", shard.alias("shard_id"), overflow.alias("overflow"), depth.alias("depth"), "shard.shard_bytes")
            out = done if out is None else out.unionByName(done)
            rows = common.stored(rows, "sharding-rest")
            if rows.isEmpty():
                return out
        # What agrees in the whole first key is one bucket for the second.
        rows = rows.withColumn("bucket", _node(F.col("first"), KEY_BITS))
    return out
