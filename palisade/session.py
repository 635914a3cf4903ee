"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Dates and hours of events are those of this zone.
TIME_ZONE = "UTC"


def in_utc(spark: SparkSession) -> SparkSession:
    """Set the one option that changes results. Sizes, partition counts and AQE are the cluster's choice."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def local_session(name: str = "palisade", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return in_utc(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; on a cluster that would be
    visible to one machine only, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/palisade/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="palisade-")


_open: ContextVar[list[str] | None] = ContextVar("settled", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """What is settled inside is deleted at the end, also after a failure. Results must have been written by then."""
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several later steps: nothing upstream runs twice, later steps prune
    columns, and a lost executor costs no more than a re-read. Inside ``scratch`` the folder goes at the end; elsewhere
    the result still needs it, and the cluster clears the shared folder.
    """
    path = shared_folder(df.sparkSession, purpose)
    if (paths := _open.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
