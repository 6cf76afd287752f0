"""Session settings the operators rely on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Buckets, trade dates and rendered times are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State that outgrows memory goes to disk; processors with state of their own need it.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

STATIC_CONF = {"spark.ui.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on in a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def create(app: str = "tapeloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session for a job. All settings not named here come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local
    session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tapeloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate folders made inside when it ends.

    Results must be written, or collected, before that.
    """
    from .sources import paths

    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            paths.remove(spark, path)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result once and go on from the written table.

    For results that several jobs read; the table outlives lost executors. It
    stays until the caller's ``scope`` ends, or for ever without one.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
