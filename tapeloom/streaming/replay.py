"""History back into a log, for the same consumers as live trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.normalize import coerce_fields
from ..sources import history

# Range of a replay that names no start: the last minute.
DEFAULT_SPAN_MS = 60_000


def publish(trades: DataFrame, start_ts: int, end_ts: int, out_path: str) -> str:
    """Write a closed range as log entries in ``(ts, seq)`` order, with their ``position``.

    Files are numbered in that order. The range is read in batch, so only the
    days it touches are listed; consumers tail what is published as any log.
    """
    entries = history.replay_entries(history.replay_range(trades, start_ts, end_ts))
    entries.write.mode("append").parquet(out_path)
    return out_path


def received(entries: DataFrame) -> DataFrame:
    """Published entries as trades, read the way every consumer reads the log."""
    names = ("ts", "price", "qty", "side")
    fields = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names))
    keep = [c for c in ("symbol", "seq") if c in entries.columns]
    return coerce_fields(entries.select(*keep, fields.alias("fields"))).drop("ofi")
