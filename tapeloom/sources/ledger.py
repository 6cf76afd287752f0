"""What a store of features was built from: a ledger of the days of a history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import paths

LEDGER = "build bigint, settings string, symbol string, trade_date date, files string, priced boolean, flowing boolean"


def listed_days(spark: SparkSession, history_path: str) -> DataFrame:
    """(symbol, trade_date, files): a fingerprint of the files of every day.

    Only names, lengths and times of files are read. Days of trades without a
    time or a symbol are left out; no bar comes from them.
    """
    paths.require(spark, history_path, "trade history")
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(history_path)
        .select(F.regexp_extract("path", "(symbol=[^/]*/trade_date=.*)$", 1).alias("file"), "length", "modificationTime")
    )
    # Folder names escape as URLs do, but for the plus sign.
    named = F.regexp_extract("file", "^symbol=([^/]*)/", 1)
    return (
        found.select(
            F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B"))).alias("symbol"),
            F.regexp_extract("file", "/trade_date=([^/]*)/", 1).try_cast("date").alias("trade_date"),
            F.xxhash64("file", "length", "modificationTime").alias("mark"),
        )
        .where("trade_date IS NOT NULL AND symbol <> '__HIVE_DEFAULT_PARTITION__'")
        .groupBy("symbol", "trade_date")
        .agg(F.concat_ws(":", F.count("*"), F.hex(F.bit_xor("mark"))).alias("files"))
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    if not paths.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(paths.join(path, "feed=builds", "*"))


def known_days(spark: SparkSession, path: str) -> DataFrame:
    """The newest line of every day: (symbol, trade_date, files, priced, flowing)."""
    newest = F.max_by(F.struct("files", "priced", "flowing"), "build").alias("line")
    return _lines(spark, path).groupBy("symbol", "trade_date").agg(newest).select("symbol", "trade_date", "line.*")


def next_build(spark: SparkSession, path: str, settings: str) -> int:
    """Number of the next build; a store keeps the settings of its first one."""
    last = _lines(spark, path).agg(F.max("build").alias("build"), F.max_by("settings", "build").alias("settings")).first()
    if last["build"] is None:
        return 0
    if last["settings"] != settings:
        raise ValueError(f"the store was built with {last['settings']}, not {settings}")
    return last["build"] + 1


def record(days: DataFrame, path: str, build: int, settings: str) -> None:
    """Add the days of a build; readers see all of its lines or none."""
    lines = days.select(
        F.lit(build).cast("bigint").alias("build"), F.lit(settings).alias("settings"),
        "symbol", "trade_date", "files", "priced", "flowing",
    )
    paths.write_once(lines, path, "builds", build)
