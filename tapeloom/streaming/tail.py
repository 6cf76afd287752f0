"""Plain consumers of a log, each with a cursor of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def tail(
    entries: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every entry of the log to ``handle`` by micro-batch, or print it.

    The cursor is the checkpoint: a new folder starts at the beginning of the
    log, a known one goes on where it stopped.
    """
    writer = entries.writeStream.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    )
    if handle is None:
        return writer.format("console").option("truncate", "false").start()
    return writer.foreachBatch(handle).start()
