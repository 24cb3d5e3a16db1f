"""Tables in the cluster's shared folder, where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# With it a query's shuffle files go when it ends, not when the driver's memory is next cleaned.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session without one gets its own."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once and read back: lost executors cost no recomputation.

    The shuffle files behind it are of no more use then and don't stay on the executors' disks.
    """
    spark = frame.sparkSession
    path = new_path(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(frame: DataFrame, *wanted: str) -> DataFrame:
    """The frame with the wanted columns under their names and all others under safe ones.

    Names that differ in case only, or clash with columns an operator adds, do no harm then; the
    first column that has a wanted name is the one meant. `toDF` gives the old names back.
    """
    names, left = [], set(wanted)
    for i, name in enumerate(frame.columns):
        names.append(name.lower() if name.lower() in left else f"c{i}")
        left.discard(name.lower())
    return frame.toDF(*names)
