"""Session settings and scratch space every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Instants are UTC everywhere, and a repeated JSON key keeps its last value.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An overwrite of a load replaces whatever an attempt before it has left.
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on; sizes stay with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Folders are listed by as many tasks as the cluster can use, not by one task per folder.
    tasks = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING_TASKS, str(min(tasks, 10_000)))
    return spark


@contextmanager
def scoped_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set options around one eager action and put the old values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session may go without one: there a folder of this machine serves all tasks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="run-")
    return f"{base}/{purpose}-{uuid.uuid4().hex}"
