"""Pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeloom import session

#: Words are runs of anything but the ASCII white space U+0020, U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that go to a Python worker at once; the default counts rows, whatever their length.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """The frame written once to the cluster's shared folder and read from there.

    Cuts the lineage, so that a lost executor costs its own tasks only. `files`
    bounds the number of files, for tables with a row per group or less.
    """
    return session.materialize(df if files is None else df.coalesce(files), purpose)


def stored_alone(spark: SparkSession, build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """The frame that `build` makes, written like `stored`; the tables it stores on the way are removed."""
    path = session.shared_folder(spark, purpose)
    with session.scope(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the frame has, ignoring case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
