"""Dense positions within each key, whatever a key's share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common


def ranked(rows: DataFrame, key: str, order: list[Column | str], name: str = "at") -> DataFrame:
    """`rows` with the place of each, from 0, among those of its `key`; NULL is a key.

    Rows are dealt by ranges of (key, order, position in the input), so that one key
    spreads over many tasks and equal rows can part. Each task counts along its range,
    and the counts of the ranges before are added: one row per key and range.
    """
    part, place, tie, before, same, lot = common.fresh(rows, "part", "place", "tie", "before", "same", "lot")
    named = [F.monotonically_increasing_id().alias(tie)]
    # The range of a row has to outlast the task that found it, hence the written table.
    fixed = common.stored(rows.select("*", *named), "rank-rows")
    dealt = fixed.repartitionByRange(F.col(key), *order, F.col(tie)).sortWithinPartitions(F.col(key), *order, F.col(tie)).drop(tie)
    schema = T.StructType([*rows.schema.fields, T.StructField(part, T.LongType()), T.StructField(place, T.LongType())])
    arrow, own = to_arrow_schema(schema), rows.columns.index(key)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(own)
            codes = column.dictionary_encode("encode").indices.to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            places = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
            first = (column[0].as_py(),)
            if first == last:
                places[: begin[1] if len(begin) > 1 else n] += seen
            last, seen = (column[n - 1].as_py(),), int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], schema=arrow)

    numbered = dealt.withColumn(part, F.spark_partition_id().cast("bigint"))
    counted = common.stored(numbered.mapInArrow(task, schema), "rank-places")
    ranges = counted.groupBy(F.col(key).alias(same), F.col(part).alias(lot)).agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy(same).orderBy(lot).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(same, lot, F.coalesce(F.sum("n").over(along), F.lit(0)).alias(before))
    joined = counted.join(ranges, (F.col(part) == F.col(lot)) & F.col(key).eqNullSafe(F.col(same)))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(before) + F.col(place)).cast("bigint").alias(name))
