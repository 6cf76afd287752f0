import math
import random

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import numbers, timebucket

import __spark_entry__ as entry


def one(spark, values, kind, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")
    return [r[0] for r in frame.select(column(F.col("x"))).collect()]


def test_float_text_is_python_str(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 64000.0, 0.01, 0.0002, 1e-05, 2.5e-07, 10000000.0, 1e16, 1.5e20, -3.25, 123456789.125]
    values += [round(rng.uniform(0, 10**5), rng.randint(0, 8)) for _ in range(2000)]
    values += [float("inf"), float("-inf"), 9999999999999998.0, 0.0001, 1e100]
    assert one(spark, values, "double", numbers.float_text) == [str(v) for v in values]
    assert one(spark, [float("nan"), None], "double", numbers.float_text) == ["nan", None]


def test_parse_float_accepts_what_float_accepts(spark):
    texts = ["64000.42", " 1.5 ", "1_000", "1e3", ".5", "5.", "inf", "-Infinity", "1.0d", "1f", "abc", "", "1__0", "_1", "0x10", None]
    expected = []
    for t in texts:
        try:
            expected.append(float(t))
        except (TypeError, ValueError):
            expected.append(None)
    assert one(spark, texts, "string", numbers.parse_float) == expected
    assert str(one(spark, ["NaN"], "string", numbers.parse_float)[0]) == "nan"


def test_display_text(spark):
    assert one(spark, [64000.42, 64005.0, 1234567.5, 0.126], "double", lambda c: numbers.dollars(c, 2)) == [
        "$64,000.42", "$64,005", "$1,234,567.5", "$0.13",
    ]
    assert one(spark, [1.23, -0.5, 0.0], "double", numbers.signed_percent) == ["+1.23%", "-0.50%", "+0.00%"]
    assert one(spark, [0.01], "double", lambda c: numbers.fixed(c, 6)) == ["0.010000"]


def test_rules():
    assert timebucket.rule_ms("1min") == 60_000
    assert timebucket.rule_ms("min") == 60_000
    assert timebucket.rule_ms("15s") == 15_000
    assert timebucket.rule_ms("250ms") == 250
    assert timebucket.rule_ms("1h30min") == 5_400_000
    assert timebucket.rule_ms("2D") == 172_800_000
    for bad in ("2W", "1M", "", "0s", "min5", "W-XYZ", "ME-DEC", "B"):
        with pytest.raises(ValueError):
            timebucket.grid(bad)


def test_floor_is_exact_for_large_and_negative(spark):
    values = [-1, -60_000, -60_001, 2**60 + 7, 59_999]
    got = one(spark, values, "bigint", lambda c: timebucket.floor_to(c, 60_000))
    assert got == [v - v % 60_000 for v in values]
    assert one(spark, values, "bigint", lambda c: timebucket.slot_of(c, 60_000)) == [v // 60_000 for v in values]


def test_days_and_clock_ignore_the_session_zone(spark):
    values = [0, 86_399_999, 86_400_000, -1, 1700000002000]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        days = one(spark, values, "bigint", lambda c: timebucket.utc_date(c).cast("string"))
        clocks = one(spark, values, "bigint", timebucket.utc_clock)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", "2023-11-14"]
    assert clocks == ["00:00:00", "23:59:59", "00:00:00", "23:59:59", "22:13:22"]


def test_six_places_without_decimals_are_those_of_round(spark):
    """Below 65,536 no decimal is made; the numbers are those of `round`, also past that, without a value and at halves."""
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.uniform(-9, 9) for _ in range(5000)] + [i / 2e6 for i in range(-50, 50)]
    values += [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 65535.9999995, 65536.0, -65536.25, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", entry.r6("v").alias("got"), (F.round(F.col("v") + entry.NUDGE, 6) + F.lit(0.0)).alias("want"))
    assert df.where("NOT got <=> want").isEmpty()
    tree = df.select(entry.r6("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in tree.lower()
