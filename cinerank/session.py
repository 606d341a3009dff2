"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cinerank.sources import versions

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "cinerank", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for tables that cut lineage.

    Executors must all see it, so a machine-local folder is only accepted on a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="cinerank-")
    return f"{base.rstrip('/')}/cinerank/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start from files that survive the loss of
    executors, compute nothing twice, and know the size of what they read."""
    return written(df, work_dir(df.sparkSession, purpose))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """In the block the shuffle files of a query go when it ends, not when the driver's memory is next cleaned."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def stored_for(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``df`` as ``stored`` gives it, for as long as the block lasts; its folder is removed at the end."""
    path = work_dir(df.sparkSession, purpose)
    try:
        yield written(df, path)
    finally:
        versions.remove(df.sparkSession, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` read back from a new folder ``path``, for callers that remove it themselves."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
