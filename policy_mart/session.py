"""Session settings for jobs that run on their own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in the block go at the end of each run, on every executor.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many steps has
    those of all its steps on disk. Make no frames in the block that are to be run twice.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def build_session(app: str = "policy_mart", **overrides: str) -> SparkSession:
    """AQE sizes, coalesces and splits shuffle partitions; the initial number only has to be
    high enough that one partition of a large shuffle fits in an executor."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.io.compression.codec": "zstd",  # shuffles of facts are a third smaller than with lz4, in about the same time
        "spark.ui.enabled": "false",
        **overrides,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
