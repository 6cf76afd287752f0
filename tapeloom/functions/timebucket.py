"""Resampling rules and exact integer bucketing."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

DAY_MS = 86_400_000

# Milliseconds per rule unit, with the older one-letter spellings.
UNIT_MS = {
    "ms": 1,
    "L": 1,
    "s": 1_000,
    "S": 1_000,
    "min": 60_000,
    "T": 60_000,
    "h": 3_600_000,
    "H": 3_600_000,
    "D": DAY_MS,
    "d": DAY_MS,
}

_PART = re.compile(r"\s*(\d*)\s*(ms|min|[LSsTHhDd])")


def rule_ms(rule: str) -> int:
    """Length of a rule such as ``1min``, ``15s``, ``h`` or ``1h30min``."""
    total, at = 0, 0
    text = rule.strip()
    while at < len(text):
        part = _PART.match(text, at)
        if part is None:
            raise ValueError(f"unknown resample rule: {rule!r}")
        total += int(part.group(1) or 1) * UNIT_MS[part.group(2)]
        at = part.end()
    if total <= 0:
        raise ValueError(f"resample rule must be longer than zero: {rule!r}")
    return total


def floor_to(value: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``value``; exact for any BIGINT."""
    return value - F.pmod(value, F.lit(step).cast("bigint"))


def slot_of(value: Column, width: int) -> Column:
    """Index of the ``width``-long slot holding ``value``, in integer arithmetic."""
    return F.call_function("div", floor_to(value, width), F.lit(width).cast("bigint"))


def utc_date(ms: Column) -> Column:
    """UTC calendar day, whatever the session's time zone."""
    return F.date_from_unix_date(slot_of(ms, DAY_MS).cast("int"))


def utc_clock(ms: Column) -> Column:
    """``HH:mm:ss`` in UTC, whatever the session's time zone."""
    second = slot_of(F.pmod(ms, F.lit(DAY_MS)), 1000)
    sixty = F.lit(60)
    parts = (slot_of(second, 3600), F.pmod(slot_of(second, 60), sixty), F.pmod(second, sixty))
    return F.format_string("%02d:%02d:%02d", *parts)


def anchored_floor(value: Column, origin: Column, step: int) -> Column:
    """Start of the bucket holding ``value`` on the grid through ``origin``."""
    return origin + floor_to(value - origin, step)


@dataclass(frozen=True)
class Grid:
    """The buckets of a rule, numbered so that neighbours differ by ``step``.

    Every bucket is made of whole ``grain`` ms cells of the epoch grid and is
    at most ``span`` ms long. ``start`` and ``label`` turn a bucket into ms.
    """

    step: int
    grain: int
    span: int
    of_cell: Callable[[Column], Column]
    start: Callable[[Column], Column]
    label: Callable[[Column], Column]
    # Set where the grid depends on the first day of the data.
    of_cell_from: Callable[[Column, Column], Column] | None = None


def _fixed(step: int) -> Grid:
    # Grids through any midnight agree if the step divides a day. If not, they
    # share the cells of the common divisor.
    aligned = DAY_MS % step == 0
    return Grid(
        step=step,
        grain=math.gcd(step, DAY_MS),
        span=step,
        of_cell=lambda cell: floor_to(cell, step),
        start=lambda bucket: bucket,
        label=lambda bucket: bucket,
        of_cell_from=None if aligned else lambda cell, origin: anchored_floor(cell, origin, step),
    )


# Weekday number of the first seven days since 1970-01-01.
WEEKDAY_OF_DAY = {"THU": 0, "FRI": 1, "SAT": 2, "SUN": 3, "MON": 4, "TUE": 5, "WED": 6}

# Months per period and whether the label is its last day.
CALENDAR = {
    "MS": (1, False),
    "ME": (1, True),
    "M": (1, True),
    "QS": (3, False),
    "QE": (3, True),
    "Q": (3, True),
    "YS": (12, False),
    "AS": (12, False),
    "YE": (12, True),
    "Y": (12, True),
    "A": (12, True),
}


def _days(ms: Column) -> Column:
    return slot_of(ms, DAY_MS)


def _weeks(last_day: int) -> Grid:
    """Weeks that end with, and are named after, a given weekday."""

    def end(bucket: Column) -> Column:
        return (bucket * 7 + last_day) * DAY_MS

    return Grid(
        step=1,
        grain=DAY_MS,
        span=7 * DAY_MS,
        of_cell=lambda cell: slot_of(_days(cell) - last_day + 6, 7),
        start=lambda bucket: end(bucket) - 6 * DAY_MS,
        label=end,
    )


def _months(count: int, label_end: bool) -> Grid:
    """Periods of ``count`` calendar months, numbered from year 0."""

    def of_cell(cell: Column) -> Column:
        day = utc_date(cell)
        return slot_of(F.year(day).cast("bigint") * 12 + F.month(day) - 1, count)

    def start(bucket: Column) -> Column:
        month = bucket * count
        first = F.make_date(slot_of(month, 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))
        return F.unix_date(first).cast("bigint") * DAY_MS

    return Grid(
        step=1,
        grain=DAY_MS,
        span=count * 31 * DAY_MS,
        of_cell=of_cell,
        start=start,
        label=(lambda bucket: start(bucket + 1) - DAY_MS) if label_end else start,
    )


def grid(rule: str) -> Grid:
    """Buckets of a resample rule.

    Fixed durations start at midnight of the first day and are named after
    their start. Weeks (``W``, ``W-WED``), months, quarters and years are whole
    UTC days; ``W`` and the ``E`` forms are named after their last day.
    """
    name, _, anchor = rule.strip().partition("-")
    if name == "W" and (anchor or "SUN") in WEEKDAY_OF_DAY:
        return _weeks(WEEKDAY_OF_DAY[anchor or "SUN"])
    if name in CALENDAR and not anchor:
        return _months(*CALENDAR[name])
    return _fixed(rule_ms(rule))
