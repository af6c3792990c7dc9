"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that hold at any scale. The number of shuffle partitions is only a
# starting point: adaptive execution merges small ones and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "tillhouse", **conf: str) -> SparkSession:
    """A session with `DEFAULTS`; keyword settings use `__` in place of dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without a zone are UTC throughout."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Shuffle files of a write go when it ends, not when the driver happens to collect garbage: what is read
# later is the written table.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Keys take some twenty times the space of their sorted, compressed files. Joins with them are planned by their
# size in memory; adaptive execution still broadcasts what turns out small.
SIZE_IN_MEMORY = {"spark.sql.sources.fileCompressionFactor": "20"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the writes inside."""
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tillhouse-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
